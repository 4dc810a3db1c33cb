import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackroom.functions.text import joined_or_empty
from stackroom.operators import measures, media, signal, vectors

DOMAINS = ["radio.example", "waves.example"]


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")


BULLETIN = """
<x-player data-now='{"id":77,"audioSrc":"https://pod.waves.example/bulletin.mp3"}'></x-player>
<x-player data-item='{"id":5550123,"audioSrc":"https://pod.waves.example/island/one.mp3"}'></x-player>
"""
QUEUE = """
<rnz-queue-media media='{"id":11,"title":"Opening","audioSrc":"https://pod.waves.example/a.mp3","canDownload":true}'></rnz-queue-media>
<rnz-queue-media media='{"id":12,"title":"Closed","audioSrc":"https://pod.waves.example/b.mp3","canDownload":false}'></rnz-queue-media>
<rnz-queue-media media='{"id":13,"title":"Elsewhere","audioSrc":"https://other.example/c.mp3","canDownload":true}'></rnz-queue-media>
<rnz-queue-media media='{"id":14,"title":"","audioSrc":"https://pod.waves.example/d.mp3"}'></rnz-queue-media>
<rnz-queue-media media="{&quot;id&quot;:11,&quot;audioSrc&quot;:&quot;https://pod.waves.example/e.mp3&quot;}"></rnz-queue-media>
<rnz-queue-media media='not json'></rnz-queue-media><rnz-queue-media></rnz-queue-media>
"""


def test_audio_of_the_requested_id_only(spark):
    df = pages(
        spark,
        ("https://www.radio.example/programme/audio/5550123/example", BULLETIN),
        ("https://www.radio.example/programme/audio/1234/example", BULLETIN),
        ("https://www.radio.example/news", BULLETIN),
        ("https://www.radio.example/audio/77", BULLETIN.replace('"', "&quot;")),
    )
    rows = df.select("page_id", media.matching_audio_url(F.col("url"), F.col("html")).alias("u")).orderBy("page_id").collect()
    assert [r["u"] for r in rows] == ["https://pod.waves.example/island/one.mp3", None, None, "https://pod.waves.example/bulletin.mp3"]


def test_downloadable_allowed_children_only(spark):
    rows = media.embedded_media(pages(spark, ("https://radio.example/x", QUEUE)), ["waves.example"]).orderBy("item_no").collect()
    assert [(r["media_id"], r["media_url"], r["title"]) for r in rows] == [
        ("11", "https://pod.waves.example/a.mp3", "Opening"),
        ("14", "https://pod.waves.example/d.mp3", "14"),
    ]


def test_links_in_document_order(spark):
    html = """<script>var x = '<a href="/no.mp3">';</script><!-- <audio src="/no.ogg"> -->
    <meta property="og:title" content="/t.mp3"><A class=x HREF=/first.html title='a > b'>x</A><audio><source src='media/one.mp3?a=1&amp;b=2'></audio>
    <meta property="og:audio" content="https://media.radio.example/two.m4a"><img src="/no.wav"><a data-href="/no.flac" href="">y</a>"""
    rows = media.page_links(pages(spark, ("https://www.radio.example/dir/page", html))).orderBy("link_no").collect()
    assert [r["link"] for r in rows] == [
        "https://www.radio.example/first.html",
        "https://www.radio.example/dir/media/one.mp3?a=1&b=2",
        "https://media.radio.example/two.m4a",
    ]
    first = media.page_media_links(pages(spark, ("https://www.radio.example/dir/page", html), ("https://www.radio.example/", "<p>")), DOMAINS)
    assert [tuple(r) for r in first.collect()] == [(0, "https://www.radio.example/dir/media/one.mp3?a=1&b=2")]


def test_asset_rules(spark):
    stray = '<audio src="https://pod.waves.example/bulletin.mp3">'
    df = pages(
        spark,
        ("https://example.org/a.mp3", ""),
        ("https://radio.example/a.MP3", ""),
        ("https://radio.example/audio/5550123", BULLETIN),
        ("https://radio.example/audio/1234/x", QUEUE),
        ("https://radio.example/audio/1234/example", stray),
        ("https://radio.example/story", stray),
        ("https://radio.example/story", "<p>nothing</p>"),
    ).withColumn("content_type", F.lit("text/html"))
    rows = media.resolve_assets(df, DOMAINS).orderBy("page_id", "item_no").collect()
    assert [(r["page_id"], r["resolution"], r["media_id"], r["media_url"]) for r in rows] == [
        (0, "not_allowed", None, None),
        (1, "direct", "direct", "https://radio.example/a.MP3"),
        (2, "matching", "5550123", "https://pod.waves.example/island/one.mp3"),
        (3, "embedded_list", "11", "https://pod.waves.example/a.mp3"),
        (3, "embedded_list", "14", "https://pod.waves.example/d.mp3"),
        (4, "embedded_list", None, None),
        (5, "first_link", "embedded", "https://pod.waves.example/bulletin.mp3"),
        (6, "first_link", None, None),
    ]
    assert [r["error"] for r in rows] == [
        "source host is not allowlisted", None, None, None, None,
        "landing page does not contain media for the requested audio ID", None, "no allowlisted media URL found",
    ]
    typed = media.resolve_assets(df.withColumn("content_type", F.lit("audio/mpeg")).filter("page_id = 6"), DOMAINS).first()
    assert typed["resolution"] == "direct"


def vector_table(spark, rows):
    return spark.createDataFrame([(r, i, v) for i, (r, v) in enumerate(rows)], "record_id string, pos bigint, embedding array<float>")


def test_top_k(spark):
    df = vector_table(spark, [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [0.8, 0.6]), ("d", [1.0]), ("e", []), ("a2", [2.0, 0.0])])
    assert [r["record_id"] for r in vectors.vector_top_k(df, [1.0, 0.0], 3).collect()] == ["a", "a2", "c"]
    assert len(vectors.vector_top_k(df, [1.0, 0.0], 10).collect()) == 6
    assert vectors.vector_top_k(df, [1.0, 0.0], 0).collect() == []
    assert vectors.vector_top_k(df.limit(0), [1.0, 0.0], 5).collect() == []
    assert vectors.vector_get(df.unionByName(df.withColumn("pos", F.col("pos") + 9).withColumn("embedding", F.array(F.lit(9.0)).cast("array<float>"))), "d").first()["embedding"] == [1.0]
    assert vectors.vector_get(df, "zz").collect() == []


def test_batch_top_k_equals_single(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(f"r{i:03d}", [float(x) for x in rng.normal(size=8)]) for i in range(200)]
    rows += [(f"copy{i:03d}", rows[0][1]) for i in range(100)] + [("short", [1.0]), ("zero", [0.0] * 8)]
    df = vector_table(spark, rows).repartition(5)
    wanted = [("q0", rows[0][1]), ("q1", rows[5][1]), ("q2", [0.0] * 8), ("q3", [1.0])]
    queries = spark.createDataFrame(wanted, "query_id string, embedding array<double>")
    heap = vectors.HEAP_ROWS
    for query_bytes, slice_rows in ((vectors.QUERY_BYTES, 100), (64, 1000), (128, 40)):
        monkeypatch.setattr(vectors, "QUERY_BYTES", query_bytes)
        monkeypatch.setattr(vectors, "SLICE_ROWS", slice_rows)
        got = vectors.vector_top_k_batch(df, queries, 7).collect()
        for name, values in wanted:
            monkeypatch.setattr(vectors, "HEAP_ROWS", 0)
            single = [tuple(r) for r in vectors.vector_top_k(df, values, 7).collect()]
            monkeypatch.setattr(vectors, "HEAP_ROWS", heap)
            assert [r["record_id"] for r in vectors.vector_top_k(df, values, 7).collect()] == [r for r, _ in single]
            batch = sorted(((r["record_id"], r["score"]) for r in got if r["query_id"] == name), key=lambda r: (-r[1], r[0]))
            assert [r for r, _ in batch] == [r for r, _ in single]
            assert np.allclose([s for _, s in batch], [s for _, s in single], atol=1e-8)
    assert vectors.vector_top_k_batch(df, queries, 0).collect() == []


def test_insert_and_embed(spark):
    df = vector_table(spark, [("a", [1.0]), ("b", [2.0])])
    grown = vectors.vector_insert(df, vector_table(spark, [("a", [3.0])])).orderBy("pos").collect()
    assert [(r["record_id"], r["pos"]) for r in grown] == [("a", 0), ("b", 1), ("a", 2)]
    embed = vectors.embed_column(lambda text: [len(text), 1.0])
    texts = spark.createDataFrame([("abc",), (None,)], "t string")
    assert [r["v"] for r in texts.select(embed("t").alias("v")).collect()] == [[3.0, 1.0], None]


def samples(spark, **recordings):
    rows = [(name, i, v) for name, values in recordings.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "recording_id string, idx bigint, v int")


def test_sample_goldens(spark):
    df = samples(spark, a=[0, 1000, -1000, 32767])
    row = signal.audio_quality(df, spark.createDataFrame([("a",), ("none",)], "recording_id string")).orderBy("recording_id").collect()
    assert (row[0]["sample_count"], row[0]["clipped_sample_ratio"], row[0]["near_silence_ratio"]) == (4, 0.25, 0.25)
    assert row[0]["rms_dbfs"] == round(20 * math.log10(math.sqrt((1000**2 * 2 + 32767**2) / 4) / 32768), 3)
    assert (row[1]["sample_count"], row[1]["rms_dbfs"], row[1]["clipped_sample_ratio"], row[1]["near_silence_ratio"]) == (0, None, 0.0, 1.0)
    windows = signal.activity_segments(df).collect()
    assert [(w["start"], w["end"], w["label"]) for w in windows] == [(0.0, round(4 / 16000, 3), "activity")]


def test_windows_and_fingerprint(spark):
    values = [0] * 4 + [20, -20, 20, -20] + [8000, -8000, 8000, 8000] + [32767]
    rows = signal.activity_segments(samples(spark, a=values), window=4).orderBy("window").collect()
    assert [r["label"] for r in rows] == ["silence", "silence", "activity", "activity"]
    assert rows[0]["rms_dbfs"] is None and rows[3]["end"] == 3.25
    tokens = [f"{r['label']}:{round(float(r['rms_dbfs'] or -99), 1)}" for r in rows]
    got = signal.activity_fingerprint(signal.activity_segments(samples(spark, a=values), window=4)).first()
    assert got["activity_fingerprint"] == hashlib.sha256("|".join(tokens).encode()).hexdigest()
    long = signal.activity_fingerprint(signal.activity_segments(samples(spark, a=values), window=4), max_seconds=3).first()
    assert long["activity_fingerprint"] == got["activity_fingerprint"] and got["rejected"] is None and long["rejected"] == "duration limit"


def test_fingerprint_of_any_length(spark):
    rows = spark.range(30_000).selectExpr("'a' AS recording_id", "id AS window", "'activity' AS label", "double(-id % 40) AS rms_dbfs")
    tokens = "|".join(f"activity:{-float(i % 40) or -99.0:.1f}" for i in range(30_000))
    assert signal.activity_fingerprint(rows).first()["activity_fingerprint"] == hashlib.sha256(tokens.encode()).hexdigest()


def test_measures(spark):
    rows = [("1", ["p", "q"], ["Images"], 1900), ("2", ["p"], None, 1907), ("3", ["p", "q"], ["Images"], 3000), ("4", None, ["Images"], None)]
    records = spark.createDataFrame(rows, "id string, p array<string>, c array<string>, year bigint").select(
        "id", joined_or_empty(F.col("p")).alias("content_partner"), joined_or_empty(F.col("c")).alias("category"), "year"
    )
    value = lambda df: df.first()[0]
    assert value(measures.total_records(records)) == 4 and value(measures.records_with_dates(records)) == 3
    assert value(measures.distinct_partners(records)) == 3 and value(measures.distinct_categories(records)) == 2
    cited = spark.createDataFrame([("k",), ("k",), (None,)], "citation_key string")
    assert value(measures.unique_citations(cited)) == 2
    assert value(measures.citation_coverage(records, cited)) == 0.5
    assert value(measures.citation_coverage(records.limit(0), cited)) is None
    assert {(r[0], r[1]) for r in measures.records_per_year(records).collect()} == {(1900, 1), (1907, 1), (None, 2)}
    assert {(r[0], r[1]) for r in measures.records_per_decade(records).collect()} == {("1900s", 2), (None, 2)}
    clusters = spark.createDataFrame([("a", "x", 0.5), ("b", "x", None), ("c", "y", 1.0)], "record_id string, cluster_id string, similarity_score double")
    assert value(measures.cluster_count(clusters)) == 2 and value(measures.average_similarity(clusters)) == pytest.approx(0.75)
    dim = measures.dim_date(spark)
    assert dim.count() == 231 and dim.filter("Year = 2030").first()["Decade"] == "2030s"
