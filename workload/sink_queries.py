"""Digests, exports, page files and the streamed event log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.fixed_values import MAX_FACET_PAGE_SIZE
from stackroom.operators import facets, transcript
from stackroom.runtime import scratch_path
from stackroom.sinks import digest, export
from stackroom.sources import search_pages
from stackroom.sources.manifest import read_lines
from stackroom.streaming import log
from workload.catalog import query
from workload.media_queries import CITED
from workload.search_queries import FACETS, RANKED, facet_sql
from workload.transcript_queries import ENTITIES, FIXED, LAGGED, MAORI_HIT, OPENINGS, PACIFIC_HIT, SUMMARIES
from workload.views import (
    EVENTS,
    LATEST,
    MUSEUM,
    RECORDS,
    SEGMENTS,
    SPOKEN,
    as_manifest,
    diarization,
    durations,
    records,
    segments,
    sql,
    table,
)

TRIMMED = "trim(description, ' ' || chr(9) || chr(10) || chr(13))"


@query("flat_frame", sql(RECORDS, "SELECT id, title, description, array_to_string(content_partner, ', ') AS content_partner, array_to_string(category, ', ') AS category FROM records"))
def flat_frame(spark, sf):
    return digest.flat_frame(records(spark, sf))


def fragment(clean: str) -> str:
    """SQL of the document fragment; ``clean`` is a pattern around each text."""
    part = clean.format
    return f"""'  <document id="' || id || '">' || chr(10) || '    <title>' || {part('title')} || '</title>' || chr(10) ||
      '    <content_partner>' || array_to_string(content_partner, ', ') || '</content_partner>' || chr(10) ||
      '    <description>' || {part(TRIMMED)} || '</description>' || chr(10) ||
      coalesce('    <dates>' || array_to_string(date, ', ') || '</dates>' || chr(10), '') || '  </document>'"""


ESCAPED = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query("rag_xml", sql(RECORDS, f"SELECT pos, id, {fragment(ESCAPED)} AS fragment FROM records"))
def rag_xml(spark, sf):
    return digest.rag_xml(records(spark, sf))


@query("rag_xml_plain", sql(RECORDS, f"SELECT pos, id, {fragment('{}')} AS fragment FROM records"))
def rag_xml_plain(spark, sf):
    return digest.rag_xml(records(spark, sf), escape=False)


@query(
    "rag_xml_file",
    sql(RECORDS, f"documents_xml AS (SELECT pos, {fragment(ESCAPED)} AS fragment FROM records)", """whole AS (
      SELECT string_split('<context_documents>' || chr(10) || string_agg(fragment, chr(10) ORDER BY pos) || chr(10) || '</context_documents>', chr(10)) AS lines
      FROM documents_xml)""",
        "SELECT CAST(n - 1 AS BIGINT) AS pos, lines[n] AS value FROM (SELECT lines, unnest(generate_series(1, len(lines))) AS n FROM whole) w"),
)
def rag_xml_file(spark, sf):
    """The lines of the written context document, numbered over its part files."""
    path = scratch_path(spark, "xml")
    digest.write_rag_xml(records(spark, sf), path)
    return read_lines(spark, path).select("pos", "value")


@query("timeline", sql(RECORDS, "SELECT date[1] AS date, pos, '- **' || date[1] || '**: ' || title AS line FROM records WHERE date IS NOT NULL"))
def timeline(spark, sf):
    return digest.timeline(records(spark, sf))


@query("citations", sql(RECORDS, CITED, "SELECT pos, id, line FROM cited"))
def citations(spark, sf):
    return digest.citations(records(spark, sf), MUSEUM)


@query("citation_rows", sql(RECORDS, CITED, "SELECT sha256(line) AS citation_key, c.id AS record_id, line AS citation_text, r.source_url FROM cited c JOIN records r USING (id)"))
def citation_rows(spark, sf):
    return digest.citation_rows(records(spark, sf), MUSEUM)


@query("markdown_table", sql(RECORDS, "SELECT pos, '| ' || id || ' | ' || title || ' | ' || array_to_string(content_partner, ', ') || ' | ' || array_to_string(category, ', ') || ' |' AS line FROM records"))
def markdown_table(spark, sf):
    return digest.markdown_table(records(spark, sf))


@query("text_lines", sql(RECORDS, """SELECT pos, '- [' || id || '] ' || title || ' (Some(["' || array_to_string(content_partner, '", "') || '"]))' AS line FROM records"""))
def text_lines(spark, sf):
    return digest.text_lines(records(spark, sf))


@query("datapackage", "SELECT count(*) AS record_count, 'tabular-data-package' AS profile, 'records.csv' AS path, CAST(5 AS INT) AS fields FROM documents")
def datapackage(spark, sf):
    row = export.datapackage(records(spark, sf), "harvest", "Harvest", "Heritage records")
    shape = F.from_json("descriptor", "profile string, resources array<struct<path: string, record_count: bigint, schema: struct<fields: array<struct<name: string>>>>>")
    first = F.element_at(shape["resources"], 1)
    return row.select(
        first["record_count"].alias("record_count"), shape["profile"].alias("profile"), first["path"].alias("path"),
        F.size(first["schema"]["fields"]).alias("fields"),
    )


@query("schema_ld", "SELECT count(*) AS size, 'https://archive.example.org/records.csv' AS url, '1800/2026' AS coverage FROM documents")
def schema_ld(spark, sf):
    row = export.schema_ld(records(spark, sf), "https://archive.example.org", "Harvest", "Heritage records")
    shape = F.from_json("descriptor", "size bigint, distribution array<struct<contentUrl: string>>, temporalCoverage string")
    return row.select(
        shape["size"].alias("size"), F.element_at(shape["distribution"], 1)["contentUrl"].alias("url"), shape["temporalCoverage"].alias("coverage")
    )


PLACED = """placed AS (
  SELECT id, row_number() OVER (ORDER BY date[1] NULLS FIRST, pos) - 1 AS place FROM records WHERE primary_collection = 'src3')"""


def export_plan(**changes):
    return export.ExportPlan("src3", per_page=7, **changes)


@query("collection_export", sql(RECORDS, PLACED, "SELECT id, place, place // 7 + 1 AS page, place % 7 AS page_pos FROM placed WHERE place >= 7 AND place < 28"))
def collection_export(spark, sf):
    rows, _ = export.collection_export(records(spark, sf), export_plan(start_page=2, max_pages=3))
    return rows.select("id", "place", "page", "page_pos")


@query(
    "collection_export_manifest",
    sql(RECORDS, PLACED, """SELECT 'src3' AS collection, CAST(7 AS INT) AS per_page, count(*) AS total_results, CAST(ceil(count(*) / 7.0) AS BIGINT) AS pages_written,
      count(*) AS records_written, true AS completed FROM placed"""),
)
def collection_export_manifest(spark, sf):
    manifest = export.write_collection_export(records(spark, sf), export_plan(), scratch_path(spark, "export"))
    return manifest.select("collection", "per_page", "total_results", "pages_written", "records_written", "completed")


@query(
    "analysis_documents",
    sql(SEGMENTS, SPOKEN, LAGGED, OPENINGS, """SELECT r.recording_id, coalesce(string_agg(CAST(start_s AS VARCHAR) || '/' || CAST(segment AS VARCHAR), ' ' ORDER BY chapter), '') AS chapters
      FROM (SELECT DISTINCT recording_id FROM segments) r LEFT JOIN openings USING (recording_id) GROUP BY 1"""),
)
def analysis_documents(spark, sf):
    """Reports with their chapters and section hints nested in order."""
    rows = segments(spark, sf)
    hints = transcript.section_hints(rows).withColumn("at", F.struct("segment", "kind_no"))
    children = {"chapters": (transcript.chapters(rows), "chapter"), "section_hints": (hints, "at")}
    report = transcript.analysis_report(rows, durations(spark, sf), diarization(spark, sf))
    documents = export.nested_documents(report, children)
    places = F.transform("chapters", lambda c: F.concat_ws("/", c["start"].cast("string"), c["segment"].cast("string")))
    return documents.select("recording_id", F.array_join(places, " ").alias("chapters"))


@query(
    "enrichment_documents",
    sql(SEGMENTS, SPOKEN, LAGGED, OPENINGS, SUMMARIES, ENTITIES, FIXED, f"""lists AS (
      SELECT recording_id, 'signals' AS list, string_agg(CAST(segment AS VARCHAR), ' ' ORDER BY segment) AS held FROM segments WHERE {MAORI_HIT} OR {PACIFIC_HIT} GROUP BY 1
      UNION ALL SELECT recording_id, 'entities', string_agg(text, '|' ORDER BY start, text) FROM entities GROUP BY 1
      UNION ALL SELECT recording_id, 'entries', string_agg(CAST(segment AS VARCHAR), ' ' ORDER BY segment) FROM segments GROUP BY 1
      UNION ALL SELECT recording_id, 'chapters', string_agg(CAST(segment AS VARCHAR), ' ' ORDER BY chapter) FROM cited GROUP BY 1
      UNION ALL SELECT recording_id, 'corrections', string_agg(corrected, '|' ORDER BY segment) FROM fixed WHERE corrected <> original GROUP BY 1)""",
        """SELECT r.recording_id, coalesce(any_value(held) FILTER (list = 'signals'), '') AS signals, coalesce(any_value(held) FILTER (list = 'entities'), '') AS entities,
             coalesce(any_value(held) FILTER (list = 'entries'), '') AS entries, coalesce(any_value(held) FILTER (list = 'chapters'), '') AS chapters,
             coalesce(any_value(held) FILTER (list = 'corrections'), '') AS corrections
           FROM (SELECT DISTINCT recording_id FROM segments) r LEFT JOIN lists l ON l.recording_id = r.recording_id GROUP BY 1"""),
)
def enrichment_documents(spark, sf):
    """The nested documents, each list told by what identifies its rows."""
    found = export.enrichment_documents(segments(spark, sf))

    def listed(name, value, separator):
        return F.array_join(F.transform(name, value), separator)

    return found.select(
        "recording_id",
        listed("language_review_signals", lambda x: x["segment"].cast("string"), " ").alias("signals"),
        listed("entity_candidates", lambda x: x["text"], "|").alias("entities"),
        listed("search_entries", lambda x: x["segment"].cast("string"), " ").alias("entries"),
        listed("chapter_summaries", lambda x: F.element_at(x["cited_segments"], 1).cast("string"), " ").alias("chapters"),
        listed("orthographic_corrections", lambda x: x["corrected"], "|").alias("corrections"),
    )


def saved_pages(spark, sf) -> str:
    """Search answers of 100 records, one page per line, with unknown keys and facets."""
    path = scratch_path(spark, "pages")
    result = F.struct("id", "title", "description", "content_partner", "category", "date", "source_url", "usage", "n_chars")
    rows = records(spark, sf).select(
        F.floor(F.col("pos") / 100).alias("page"), F.col("pos"), result.alias("record"), F.col("primary_collection").alias("term")
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "record"))), lambda x: x["record"])
    paged = rows.groupBy("page").agg(F.count(F.lit(1)).alias("result_count"), listed.alias("results"))
    terms = rows.groupBy("page", "term").agg(F.count(F.lit(1)).alias("n")).groupBy("page").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "n"))).alias("terms")
    )
    body = F.struct("result_count", "results", F.create_map(F.lit("collection"), F.col("terms")).alias("facets"))
    name = F.format_string("page-%06d", F.col("page") + 1)
    paged.join(terms, "page").select(name.alias("name"), body.alias("search")).write.json(path)
    return path


@query("read_search_pages", sql(RECORDS, "SELECT pos // 100 + 1 AS page, pos % 100 AS page_pos, id, title, CAST(length(description) AS INT) AS chars, array_to_string(category, '|') AS category, len(date) AS dates FROM records"))
def pages_round_trip(spark, sf):
    rows = search_pages.read_search_pages(spark, saved_pages(spark, sf), one_per_file=False)
    return rows.filter(F.col("rejected").isNull()).select(
        "page", F.col("page_pos").cast("bigint").alias("page_pos"), "id", "title", F.length("description").alias("chars"),
        F.array_join("category", "|").alias("category"), F.when(F.col("date").isNotNull(), F.size("date").cast("bigint")).alias("dates"),
    )


@query("split_extra_fields", sql(RECORDS, "SELECT id, '\"' || usage || '\"' AS usage, CAST(n_chars AS VARCHAR) AS n_chars FROM records"))
def extra_fields(spark, sf):
    rows = search_pages.read_search_pages(spark, saved_pages(spark, sf), one_per_file=False)
    usage = F.concat(F.lit('"'), F.col("extra_fields")["usage"], F.lit('"'))
    return rows.select("id", usage.alias("usage"), F.col("extra_fields")["n_chars"].alias("n_chars"))


@query("read_facet_map", sql(RECORDS, "SELECT pos // 100 + 1 AS page, 'collection' AS field, primary_collection AS term, count(*) AS count FROM records GROUP BY 1, 2, 3"))
def facet_map(spark, sf):
    return search_pages.read_facet_map(spark, saved_pages(spark, sf), one_per_file=False).select("page", "field", "term", "count")


@query("read_detail_records", sql(RECORDS, "SELECT id, title, primary_collection, array_to_string(object_url, ' ') AS object_urls FROM records"))
def detail_round_trip(spark, sf):
    path = scratch_path(spark, "details")
    record = F.struct(F.col("pos").alias("id"), "title", "description", F.array("primary_collection").alias("primary_collection"), "object_url")
    records(spark, sf).select(record.alias("record")).write.json(path)
    rows = search_pages.read_detail_records(spark, path, one_per_file=False)
    return rows.select("id", "title", F.element_at("primary_collection", 1).alias("primary_collection"), F.array_join("object_urls", " ").alias("object_urls"))


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return as_manifest(log.read_event_stream(spark, f"{sf}/events*.parquet", schema, "parquet"))


STATE = ("record_id", "pos", "event_id", "event", "review_required")


def streamed_state(spark, sf) -> str:
    """The event table taken as a stream into a new state table."""
    state = scratch_path(spark, "state")
    log.write_latest_state(event_stream(spark, sf), state, scratch_path(spark, "state-log")).awaitTermination()
    return state


@query("stream_latest_state", sql(EVENTS, LATEST, f"SELECT {', '.join(STATE)} FROM latest"))
def stream_latest_state(spark, sf):
    return log.read_latest_state(spark, streamed_state(spark, sf)).select(*STATE)


@query(
    "stream_summary",
    sql(EVENTS, LATEST, """SELECT event, count(*) AS state_records, (SELECT count(*) FROM latest) AS records,
      (SELECT count(*) FROM latest WHERE review_required) AS review_required FROM latest GROUP BY 1"""),
)
def stream_summary(spark, sf):
    return log.stream_summary(spark, streamed_state(spark, sf))


def taken(spark, rows, name: str):
    path = scratch_path(spark, name)
    log.write_appended(rows, path, scratch_path(spark, name + "-log")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@query("stream_discover", sql(EVENTS, "SELECT DISTINCT record_id FROM manifest_events WHERE record_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)"))
def stream_discover(spark, sf):
    """New record ids of the stream; customers with a positive balance stand for the known records."""
    known = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").cast("string").alias("record_id"))
    seen = scratch_path(spark, "seen")
    log.write_unseen(event_stream(spark, sf), seen, scratch_path(spark, "seen-log"), known).awaitTermination()
    return log.read_unseen(spark, seen).select("record_id")


@query("stream_event_dedup", "SELECT event_id, event_type FROM events")
def stream_event_dedup(spark, sf):
    """Every event delivered twice; each passes once."""
    schema = T.StructType([f if f.name != "ts" else T.StructField("ts", T.TimestampNTZType()) for f in table(spark, sf, "events").schema])
    events = log.read_event_stream(spark, f"{sf}/events*.parquet", schema, "parquet")
    twice = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", F.explode(F.lit([1, 2])).alias("delivery"))
    return taken(spark, log.without_repeats(twice, "ts").select("event_id", "event_type"), "once")


@query("facet_rows", sql(RECORDS, facet_sql("records"), RANKED, "SELECT field, term, count FROM ranked"))
def facet_rows(spark, sf):
    """Facet maps of all terms, as answers of several pages hold them, back to rows."""
    counts = facets.facet_counts(records(spark, sf), FACETS)
    page = F.pmod(F.xxhash64("term"), F.lit(1024))
    maps = counts.withColumn("page", page).groupBy("field", "page").agg(F.map_from_entries(F.collect_list(F.struct("term", "count"))).alias("terms"))
    return search_pages.facet_rows(maps.select(F.create_map("field", "terms").alias("facets")))
