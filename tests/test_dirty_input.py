"""Long and broken input that must neither end the JVM nor lose a value."""

import html

import pytest
from pyspark.sql import functions as F

from stackroom.functions.urls import unescaped
from stackroom.operators import archive, enrichment, media

MILLION = 1_000_000
PAGES = {
    "unquoted": "<a href=" + "x" * MILLION + "><a href='/ok.mp3'>",
    "unclosed": "<a " + "word " * 2000 + "<a href='/ok.mp3'>",
    "quote": "<a title=\"" + "y" * MILLION,
    "attributes": "<a " + " ".join(f"n{i}='v'" for i in range(20_000)) + " href='/ok.mp3'>",
    "script": "<script>" + "z" * MILLION + "</script><a href='/ok.mp3'>",
    "spaces": "<a" + " " * 20_000 + "href='/ok.mp3'>",
}


def pages(spark):
    rows = [(name, "https://radio.example/p", body) for name, body in PAGES.items()]
    return spark.createDataFrame(rows, "page_id string, url string, html string")


@pytest.mark.parametrize("run", [media.page_links, lambda p: media.page_media_links(p, ["radio.example"]), lambda p: media.embedded_media(p, ["radio.example"]), lambda p: media.resolve_assets(p, ["radio.example"])])
def test_long_tags(spark, run):
    found = run(pages(spark)).collect()
    assert isinstance(found, list)


def test_links_behind_long_tags(spark):
    found = {r["page_id"] for r in media.page_media_links(pages(spark), ["radio.example"]).collect()}
    assert {"unquoted", "attributes", "script", "spaces"} <= found


def test_long_word(spark):
    text = "A" + "b" * MILLION + " then Te Papa"
    rows = spark.createDataFrame([("r", 0, 0.0, text)], "recording_id string, segment int, start_s double, text string")
    assert {len(r["text"]) for r in enrichment.entity_candidates(rows).collect()} == {MILLION + 1, len("Te Papa")}


@pytest.mark.parametrize(
    "text", ["https:&#x2F;&#x2F;a&#47;b", "a&nbsp;b&middot;&copy;&hellip;", "&amp;quot;&quot;&apos;", "&#128;&#x99;", "&unknown; & x", "&#1114112;&#xD800;", "no marks", "&lt;&gt;&#128512;"]
)
def test_references(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(unescaped(F.col("t"))).first()[0]
    assert got == html.unescape(text)


def test_first_item_per_id_of_a_long_queue(spark):
    ids = [i % 700 for i in range(3000)]
    rows = spark.createDataFrame([(ids,)], "ids array<int>")
    items = F.transform("ids", lambda x, i: F.struct(x.cast("string").alias("media_id"), i.alias("n")))
    got = rows.select(media._first_per_id(items).alias("kept")).first()["kept"]
    assert [int(r["media_id"]) for r in got] == list(range(700)) and [r["n"] for r in got] == list(range(700))


def test_all_pending_work(spark):
    events = spark.range(120).selectExpr("string(id) AS record_id", "id AS pos", "'discovered' AS event")
    assert archive.pending_work(events, limit=100).count() == 100 and archive.pending_work(events).count() == 5
