"""Duplicates, similarity, candidates, checksums and page addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.functions.arrays import positional_similarity
from stackroom.functions.dates import metadata_year, year_from_digits
from stackroom.functions.urls import host_allowed, https_host
from stackroom.operators import archive, dedup
from stackroom.runtime import scratch_path
from stackroom.sources.tables import file_checksum, read_pages
from workload.catalog import exact, query
from workload.views import (
    DOMAINS,
    EVENTS,
    LATEST,
    RECORDS,
    manifest_events,
    records,
    sql,
    table,
)

TITLE_KEY = "trim(lower(title), ' ' || chr(9) || chr(10) || chr(13))"


@query(
    "dedup_by_title",
    sql(RECORDS, f"SELECT id, title, pos FROM records WHERE {TITLE_KEY} <> '' QUALIFY row_number() OVER (PARTITION BY {TITLE_KEY} ORDER BY pos) = 1"),
)
def dedup_by_title(spark, sf):
    return dedup.dedup_by_title(records(spark, sf)).select("id", "title", "pos")


@query("dedup_by_id", "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def dedup_by_id(spark, sf):
    return dedup.dedup_by_id(table(spark, sf, "events").select("event_id", "user_id", "event_type"), "user_id", "event_id")


@query(
    "exact_duplicates",
    sql(EVENTS, "processed AS (SELECT * FROM manifest_events WHERE event = 'processed')", """
      SELECT p.pos, p.record_id, p.normalized_sha256,
        (SELECT arg_min(q.record_id, q.pos) FROM processed q
         WHERE q.normalized_sha256 = p.normalized_sha256 AND q.record_id <> p.record_id AND q.pos < p.pos) AS duplicate_of
      FROM processed p"""),
)
def exact_duplicates(spark, sf):
    processed = manifest_events(spark, sf).filter(F.col("event") == "processed")
    return dedup.exact_duplicates(processed).select("pos", "record_id", "normalized_sha256", "duplicate_of")


@query(
    "document_copies",
    """WITH processed AS (SELECT doc_id AS pos, source AS record_id, sha256(text) AS normalized_sha256 FROM documents)
       SELECT p.pos, p.record_id,
         (SELECT arg_min(q.record_id, q.pos) FROM processed q
          WHERE q.normalized_sha256 = p.normalized_sha256 AND q.record_id <> p.record_id AND q.pos < p.pos) AS duplicate_of
       FROM processed p""",
)
def document_copies(spark, sf):
    """The content-duplicate rule over all documents, their source standing for the record."""
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("pos"), F.col("source").alias("record_id"), F.sha2("text", 256).alias("normalized_sha256")
    )
    return dedup.exact_duplicates(rows).select("pos", "record_id", "duplicate_of")


ITEMS = "items AS (SELECT record_id, pos, fingerprint FROM latest WHERE event = 'processed')"
CODES = "codes AS (SELECT DISTINCT fingerprint FROM manifest_events WHERE event = 'processed')"


def score(a: str, b: str) -> str:
    equal = f"len(list_filter(list_zip(string_split({a}, ''), string_split({b}, '')), lambda z: z[1] = z[2]))"
    return exact(f"{equal} / CAST(greatest(length({a}), length({b})) AS DOUBLE)", 6)


def processed_items(spark, sf):
    events = manifest_events(spark, sf).select("record_id", "pos", "event", "fingerprint")
    return archive.latest_by_record(events).filter(F.col("event") == "processed")


@query(
    "similar_fingerprints",
    sql(EVENTS, CODES, f"""
      SELECT a.fingerprint, b.fingerprint AS similar, {score('a.fingerprint', 'b.fingerprint')} AS score
      FROM codes a JOIN codes b ON length(a.fingerprint) > 0 WHERE {score('a.fingerprint', 'b.fingerprint')} >= 0.92"""),
)
def similar_fingerprints(spark, sf):
    processed = manifest_events(spark, sf).filter(F.col("event") == "processed")
    return dedup.similar_fingerprints(processed).select("fingerprint", "similar", "score")


@query(
    "similarity_candidates",
    sql(EVENTS, LATEST, ITEMS, f"""pairs AS (
      SELECT i.record_id, j.record_id AS other, j.pos AS other_pos, {score('i.fingerprint', 'j.fingerprint')} AS score
      FROM items i JOIN items j ON j.pos < i.pos)""",
        """SELECT i.record_id, arg_min(p.other, p.other_pos) AS first_candidate, arg_min(p.score, p.other_pos) AS score,
             count(p.other) > 0 AS review_required
           FROM items i LEFT JOIN pairs p ON p.record_id = i.record_id AND p.score >= 0.92 GROUP BY 1"""),
)
def similarity_candidates(spark, sf):
    found = dedup.similarity_candidates(processed_items(spark, sf).select("record_id", "pos", "fingerprint"))
    return found.select("record_id", "first_candidate", "score", "review_required")


@query(
    "activity_similarity",
    sql(EVENTS, f"SELECT event_id, {score('fingerprint', 'normalized_sha256')} AS score FROM manifest_events"),
)
def activity_similarity(spark, sf):
    score_column = positional_similarity(F.col("fingerprint"), F.col("normalized_sha256"))
    return manifest_events(spark, sf).select("event_id", score_column.alias("score"))


CANDIDATES = """list_distinct_in_order AS (
  SELECT id, list_filter(list_concat(object_url, CASE WHEN source_url IS NULL THEN [] ELSE [source_url] END),
    lambda u: starts_with(u, 'https://')) AS urls FROM records)"""


@query(
    "media_candidates",
    sql(RECORDS, CANDIDATES, "SELECT id, array_to_string(list_filter(urls, lambda u, i: list_position(urls, u) = i), ' ') AS urls FROM list_distinct_in_order"),
)
def media_candidates(spark, sf):
    urls = dedup.media_candidates(F.col("object_url"), F.array_compact(F.array("source_url")))
    return records(spark, sf).select("id", F.concat_ws(" ", urls).alias("urls"))


@query(
    "distinct_entities",
    sql("entities AS (SELECT conv_id AS recording_id, role AS text, turn // 2 AS start FROM conversations)", "SELECT DISTINCT recording_id, text, start FROM entities"),
)
def distinct_entities(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("recording_id"), F.col("role").alias("text"), F.floor(F.col("turn") / 2).alias("start")
    )
    return dedup.distinct_entities(rows)


@query(
    "file_checksum",
    "SELECT CAST(item_id AS VARCHAR) AS name, CAST(strlen(text) + 1 AS BIGINT) AS length, sha256(text || chr(10)) AS sha256 FROM benchmark",
)
def checksum(spark, sf):
    """Files that are written from the benchmark passages, one per passage."""
    path = scratch_path(spark, "passages")
    table(spark, sf, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    files = file_checksum(spark, path, "part-*")
    return files.select(F.regexp_extract("path", "item_id=([^/]+)/", 1).alias("name"), "length", "sha256")


HOST = r"lower(regexp_extract(url, '^[Hh][Tt][Tt][Pp][Ss]://(?:[^/?#@]*@)?([^/:?#]+)', 1))"


@query(
    "host_allowed",
    f"""WITH hosts AS (SELECT page_id, nullif(rtrim({HOST}, '.'), '') AS host FROM pages)
        SELECT page_id, host, host = 'example.com' OR ends_with(host, '.example.com') OR host = 'example.org' OR ends_with(host, '.example.org') AS allowed
        FROM hosts""",
)
def allowed_hosts(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("page_id", https_host(url).alias("host"), host_allowed(url, DOMAINS).alias("allowed"))


@query(
    "source_url_pick",
    sql(RECORDS, "SELECT id, 'https://' || primary_collection || '.example.com/item/' || id AS source FROM records"),
)
def source_url_pick(spark, sf):
    urls = dedup.media_candidates(F.col("object_url"), F.array_compact(F.array("source_url")))
    return records(spark, sf).select("id", archive.allowlisted_source(urls, DOMAINS).alias("source"))


@query("read_pages", "SELECT page_id, url, CAST(length(html) AS INT) AS chars, md5(html) AS digest FROM pages")
def pages_scan(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").alias("chars"), F.md5("html").alias("digest"))


@query(
    "metadata_year",
    sql(RECORDS, r"SELECT id, TRY_CAST(nullif(regexp_extract(array_to_string(coalesce(date, []), ' ') || ' ' || usage || ' ' || coalesce(source_url, ''), '\b((18|19|20)\d{2})\b', 1), '') AS INT) AS year FROM records"),
)
def year_of_metadata(spark, sf):
    rows = records(spark, sf)
    return rows.select("id", metadata_year(F.col("date"), F.array("usage"), F.array("source_url")).alias("year"))


@query(
    "year_from_digits",
    sql(RECORDS, "SELECT id, TRY_CAST(substr(regexp_replace(date[1], '[^0-9]', '', 'g'), 1, 4) AS BIGINT) AS year FROM records"),
)
def year_of_digits(spark, sf):
    return records(spark, sf).select("id", year_from_digits(F.try_element_at("date", F.lit(1))).alias("year"))
