import hashlib
import json

import pytest
from pyspark.sql import functions as F

from stackroom.operators import transcript
from stackroom.sinks import captions, digest, export
from stackroom.sources import search_pages, tables

RECORD = "pos bigint, id string, title string, description string, content_partner array<string>, category array<string>, date array<string>, source_url string, primary_collection string"


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        (0, "1", "Kauri <b>", " tall & old ", ["Te Papa", "Archive"], ["Images"], ["1950", "1951"], "https://s/1", "G"),
        (1, "2", "Plain", None, None, None, None, None, "G"),
        (2, "3", "Early", "x", ["Te Papa"], [], ["1900"], None, "H"),
        (3, "4", "Tie", "y", [], ["Text"], ["1950"], None, "G"),
    ]
    return spark.createDataFrame(rows, RECORD)


def page(results, count=None, facets=None):
    search = {"result_count": count if count is not None else len(results), "results": results}
    return {"search": {**search, **({"facets": facets} if facets is not None else {})}}


def test_search_pages(spark, tmp_path):
    full = {"id": "a", "title": "T", "description": None, "category": ["Images"], "license": "cc", "usage": ["Share"], "nested": {"x": 1}}
    pages = [
        page([full, {"id": "b", "title": "U"}], 42, {"category": {"Images": 10, "Text": 5}}),
        page([{"id": 7, "title": "number"}, {"title": "no id"}, {"id": "c", "title": "V"}], 42),
    ]
    for n, body in enumerate(pages, 1):
        (tmp_path / f"page-{n:06d}.json").write_text(json.dumps(body, indent=1))
    rows = {(r["page"], r["page_pos"]): r for r in search_pages.read_search_pages(spark, str(tmp_path)).collect()}
    assert len(rows) == 5
    assert rows[1, 0]["extra_fields"] == {"license": "cc", "usage": '["Share"]', "nested": '{"x":1}'}
    assert rows[1, 0]["description"] is None and rows[1, 0]["category"] == ["Images"]
    assert rows[1, 1]["extra_fields"] is None and rows[1, 1]["rejected"] is None
    assert [rows[2, i]["rejected"] for i in range(3)] == ["missing id or title", "missing id or title", None]
    facets = search_pages.read_facet_map(spark, str(tmp_path)).collect()
    assert {(r["field"], r["term"], r["count"]) for r in facets} == {("category", "Images", 10), ("category", "Text", 5)}
    counts = search_pages.read_result_counts(spark, str(tmp_path)).collect()
    assert [r["result_count"] for r in counts] == [42, 42]


def test_detail_records(spark, tmp_path):
    body = {"record": {"id": 5550123, "title": "Island voices", "primary_collection": ["Radio"], "landing_url": "https://www.radio.example/x", "object_url": ["https://a", "https://b"]}}
    (tmp_path / "5550123.json").write_text(json.dumps(body, indent=2))
    row = search_pages.read_detail_records(spark, str(tmp_path)).first()
    assert (row["id"], row["title"], row["primary_collection"]) == ("5550123", "Island voices", ["Radio"])
    assert row["landing_urls"] == ["https://www.radio.example/x"] and row["object_urls"] == ["https://a", "https://b"] and row["urls"] is None


def test_csv_tables(spark, tmp_path):
    (tmp_path / "collections.csv").write_text('value,count\n"Maps, plans",12\nRadio,777131\n', encoding="utf-8")
    rows = tables.read_collections_export(spark, str(tmp_path / "collections.csv")).collect()
    assert [tuple(r) for r in rows] == [("Maps, plans", 12), ("Radio", 777131)]
    (tmp_path / "records.csv").write_text('id,title,description,content_partner,category,date,display_url,source_url\n1,"a ""q""","line\nbreak",p,c,12 May 1987,,s\n', encoding="utf-8")
    row = tables.read_undated_records(spark, str(tmp_path / "records.csv")).first()
    assert (row["title"], row["description"], row["year"]) == ('a "q"', "line\nbreak", 1219)


def test_checksums(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.bin").write_bytes(b"abc")
    row = tables.file_checksum(spark, str(tmp_path)).first()
    assert row["sha256"] == hashlib.sha256(b"abc").hexdigest() and row["length"] == 3
    assert tables.checksum_lines(tables.file_checksum(spark, str(tmp_path))).first()["line"] == f"{row['sha256']}  x.bin"


def lines(df, *order, column="line"):
    return [r[column] for r in df.orderBy(*order).collect()]


def test_context_xml(records, tmp_path):
    plain = lines(digest.rag_xml(records, escape=False), "pos", column="fragment")
    assert plain[0] == (
        '  <document id="1">\n    <title>Kauri <b></title>\n    <content_partner>Te Papa, Archive</content_partner>\n'
        "    <description>tall & old</description>\n    <dates>1950, 1951</dates>\n  </document>"
    )
    assert plain[1] == '  <document id="2">\n    <title>Plain</title>\n  </document>'
    assert "<title>Kauri &lt;b&gt;</title>" in lines(digest.rag_xml(records), "pos", column="fragment")[0]
    digest.write_rag_xml(records, str(tmp_path / "xml"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "xml").glob("part-*")))
    assert text.startswith("<context_documents>\n") and text.endswith("</context_documents>\n") and text.count("<document ") == 4


def test_timeline(records, tmp_path):
    assert [r["line"] for r in digest.timeline(records).collect()] == ["- **1900**: Early", "- **1950**: Kauri <b>", "- **1950**: Tie"]
    digest.write_timeline(records.filter("id = '2'"), str(tmp_path / "none"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))
    assert text == "# Historical Research Timeline\n\n*No dates associated with these records.*\n"


def test_citations_and_lines(records):
    got = lines(digest.citations(records, "fallback.example"), "pos")
    assert got[0] == '- "Kauri <b>" (1950), *Te Papa*. Retrieved from: <https://s/1>'
    assert got[1] == '- "Plain" (n.d.), *Unknown Partner*. Retrieved from: <fallback.example>'
    assert lines(digest.markdown_table(records), "pos")[0] == "| 1 | Kauri <b> | Te Papa, Archive | Images |"
    assert lines(digest.markdown_table(records), "pos")[1] == "| 2 | Plain |  |  |"
    assert lines(digest.text_lines(records), "pos")[:2] == ['- [1] Kauri <b> (Some(["Te Papa", "Archive"]))', "- [2] Plain (None)"]
    flat = {r["id"]: tuple(r) for r in digest.flat_frame(records).collect()}
    assert flat["2"] == ("2", "Plain", "", "", "") and flat["1"][3] == "Te Papa, Archive"
    assert digest.flat_frame(records.limit(0)).columns == ["id", "title", "description", "content_partner", "category"]


def test_captions(spark, tmp_path):
    df = spark.createDataFrame(
        [("r", 0, 1.0, 2.5, "SPEAKER_00", " Kia ora "), ("r", 1, 3.0, 4.0, None, "ok"), ("s", 0, 0.0, 1.0, "SPEAKER_01", "x")],
        "recording_id string, segment bigint, start_s double, end_s double, speaker string, text string",
    )
    row = captions.captions(df).filter("recording_id = 'r' and segment = 0").first()
    assert row["srt"] == "1\n00:00:01,000 --> 00:00:02,500\n[SPEAKER_00] Kia ora\n" and row["plain"] == "[SPEAKER_00] Kia ora"
    captions.write_captions(df, str(tmp_path / "vtt"), "vtt")
    text = "".join(p.read_text() for p in sorted((tmp_path / "vtt" / "recording_id=r").glob("part-*")))
    assert text == "WEBVTT\n\n00:00:01.000 --> 00:00:02.500\n[SPEAKER_00] Kia ora\n\n00:00:03.000 --> 00:00:04.000\n[SPEAKER_UNKNOWN] ok\n\n"
    captions.write_caption_table(df, str(tmp_path / "table"), "srt")
    blocks = spark.read.parquet(str(tmp_path / "table")).orderBy("recording_id", "segment").collect()
    assert [b["value"].split("\n")[0] for b in blocks] == ["1", "2", "1"]
    with pytest.raises(ValueError):
        captions.caption_blocks(df, "ass")
    turn = spark.createDataFrame([("recording", 0, 1.25, 3.75, "SPEAKER_00")], "recording_id string, segment bigint, start_s double, end_s double, speaker string")
    assert captions.rttm(turn).first()["line"] == "SPEAKER recording 1 1.250 2.500 <NA> <NA> SPEAKER_00 <NA> <NA>"


def test_descriptors(records):
    body = json.loads(export.datapackage(records, "n", "t", "d").first()["descriptor"])
    assert body["resources"][0]["record_count"] == 4 and len(body["resources"][0]["schema"]["fields"]) == 5
    body = json.loads(export.schema_ld(records, "https://x", "n", "d").first()["descriptor"])
    assert body["@type"] == "Dataset" and body["size"] == 4 and body["distribution"][0]["contentUrl"] == "https://x/records.csv"


@pytest.mark.parametrize(
    "plan, pages, written, completed",
    [
        ({"per_page": 2}, 2, 3, True),
        ({"per_page": 2, "max_pages": 1}, 1, 2, False),
        ({"per_page": 2, "start_page": 2}, 1, 1, True),
        ({"per_page": 2, "start_page": 5, "max_pages": 1}, 1, 0, True),
        ({"per_page": 100}, 1, 3, True),
        ({"per_page": 2, "max_pages": 0}, 0, 0, False),
    ],
)
def test_export_manifest(records, plan, pages, written, completed):
    _, manifest = export.collection_export(records, export.ExportPlan("G", **plan))
    row = manifest.first()
    assert (row["total_results"], row["pages_written"], row["records_written"], row["completed"]) == (3, pages, written, completed)


def test_export_files(spark, records, tmp_path):
    out = str(tmp_path / "out")
    export.write_collection_export(records, export.ExportPlan("G", per_page=2, sort="title"), out)
    assert [r["id"] for r in spark.read.json(f"{out}/records.jsonl").collect()] == ["1", "2", "4"]
    pages = spark.read.json(f"{out}/pages").orderBy("name").collect()
    assert [(p["name"], [x["id"] for x in p["results"]]) for p in pages] == [("page-000001", ["1", "2"]), ("page-000002", ["4"])]
    with pytest.raises(ValueError):
        export.ExportPlan("G", start_page=0)
    with pytest.raises(ValueError):
        export.ExportPlan("G", per_page=500)


def test_nested_documents(spark):
    rows = [("a", i, i * 10.0, i * 10.0 + 1, f"joining us {i}", None, []) for i in range(4)] + [("b", 0, 0.0, 1.0, "x", None, [])]
    segments = spark.createDataFrame(rows, "recording_id string, segment bigint, start_s double, end_s double, text string, speaker string, words array<struct<word: string, score: double>>")
    report = segments.select("recording_id").distinct()
    children = {"chapters": (transcript.chapters(segments), "chapter")}
    documents = export.nested_documents(report, children)
    assert {r["recording_id"]: [c["segment"] for c in r["chapters"]] for r in documents.collect()} == {"a": [0, 1, 2, 3], "b": [0]}
    parts = export.nested_documents(report, children, part_rows=3).orderBy("recording_id", "part").collect()
    assert [(r["recording_id"], r["part"], [c["segment"] for c in r["chapters"]]) for r in parts] == [("a", 0, [0, 1, 2]), ("a", 1, [3]), ("b", 0, [0])]


def test_nested_documents_of_a_long_recording(spark):
    rows = spark.range(60_000).select(F.lit("a").alias("recording_id"), F.col("id").alias("chapter"), (F.col("id") * 2).alias("start"))
    parts = export.nested_documents(spark.createDataFrame([("a",), ("b",)], "recording_id string"), {"chapters": (rows, "chapter")})
    found = {(r["recording_id"], r["part"]): [c["start"] for c in r["chapters"]] for r in parts.collect()}
    assert found[("a", 0)] + found[("a", 1)] == list(range(0, 120_000, 2)) and found[("b", 0)] == [] and len(found) == 3
