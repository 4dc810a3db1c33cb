"""Event-log state tables, contracts, audits and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.fixed_values import REQUIRED_ITEM_FILES
from stackroom.functions.arrays import flags
from stackroom.operators import archive, contract, evaluate
from stackroom.operators.contract import Rule
from stackroom.plans.order import row_index
from stackroom.runtime import scratch_path
from stackroom.sources.manifest import read_manifest
from workload.catalog import exact, query
from workload.views import (
    DOMAINS,
    EVENTS,
    LATEST,
    PAIRS,
    RECORDS,
    manifest_events,
    records,
    sql,
    table,
    transcript_pairs,
)

STATE = ("record_id", "pos", "event_id", "event", "retry_count", "review_required")


@query("latest_by_record", sql(EVENTS, LATEST, f"SELECT {', '.join(STATE)} FROM latest"))
def latest_by_record(spark, sf):
    return archive.latest_by_record(manifest_events(spark, sf).select(*STATE))


@query(
    "pending_work",
    sql(EVENTS, LATEST, "firsts AS (SELECT record_id, min(pos) AS first_pos FROM manifest_events GROUP BY 1)",
        "SELECT record_id, first_pos, event, pos FROM latest JOIN firsts USING (record_id) WHERE event IN ('discovered', 'retry') ORDER BY first_pos LIMIT 5"),
)
def pending_work(spark, sf):
    return archive.pending_work(manifest_events(spark, sf).select("record_id", "event", "pos"))


@query(
    "retry_transition",
    sql(EVENTS, """SELECT event_id, coalesce(retry_count, 0) + 1 AS retry_count,
      CASE WHEN coalesce(retry_count, 0) + 1 <= 3 THEN 'retry' ELSE 'rejected' END AS event, substr(reason, 1, 500) AS reason
      FROM manifest_events"""),
)
def retry_transition(spark, sf):
    failed = archive.retry_transition(manifest_events(spark, sf))
    return failed.select("event_id", F.col("retry_count").cast("bigint").alias("retry_count"), "event", "reason")


@query(
    "new_events",
    sql(EVENTS, """SELECT pos, CAST(32 AS INT) AS id_chars,
      CASE WHEN pos % 9 = 0 AND pos % 4 = 0 THEN 'manifest event missing: record_id, rights_basis'
           WHEN pos % 9 = 0 THEN 'manifest event missing: record_id'
           WHEN pos % 4 = 0 THEN 'manifest event missing: rights_basis' END AS rejected FROM manifest_events"""),
)
def new_events(spark, sf):
    faulty = manifest_events(spark, sf).withColumns(
        {
            "record_id": F.when(F.col("pos") % 9 == 0, "").otherwise(F.col("record_id")),
            "rights_basis": F.when(F.col("pos") % 4 != 0, F.lit("authorised")),
        }
    )
    return archive.new_events(faulty).select("pos", F.length("event_id").alias("id_chars"), "rejected")


@query("append_events", sql(EVENTS, "SELECT pos AS seq, record_id, event FROM manifest_events"))
def append_events(spark, sf):
    """The log written in two appends, the second continuing the first."""
    path = scratch_path(spark, "log")
    events = manifest_events(spark, sf).withColumn("rights_basis", F.lit("authorised"))
    half = events.agg(F.floor((F.max("pos") + 1) / 2)).scalar()
    archive.append_events(None, events.filter(F.col("pos") < half), path)
    log = spark.read.schema("seq bigint").json(path)
    archive.append_events(log, events.filter(F.col("pos") >= half).withColumn("pos", F.col("pos") - half), path)
    return spark.read.schema("seq bigint, record_id string, event string").json(path)


@query("read_manifest", sql(EVENTS, "SELECT pos, event_id, record_id, event, retry_count, review_required FROM manifest_events"))
def manifest_round_trip(spark, sf):
    """The log written as ordered JSON lines and read back in line order."""
    path = scratch_path(spark, "manifest")
    events = manifest_events(spark, sf).drop("ts")
    events.orderBy("pos").drop("pos").write.json(path)
    return read_manifest(spark, path).select("pos", "event_id", "record_id", "event", "retry_count", "review_required")


ASSETS = """assets AS (
  SELECT *, 'https://cdn.example.com/' || record_id || '/' AS base, 1 + pos % 3 AS n FROM latest)"""


def items_with_assets(spark, sf):
    latest = archive.latest_by_record(manifest_events(spark, sf).select("record_id", "pos", "event", "retry_count"))
    asset = lambda i: F.struct(
        i.cast("string").alias("media_id"),
        F.concat(F.lit("https://cdn.example.com/"), "record_id", F.lit("/"), i.cast("string")).alias("media_url"),
        F.concat(F.lit("Part "), i.cast("string")).alias("title"),
    )
    return latest.withColumn("assets", F.transform(F.sequence(F.lit(1).cast("bigint"), 1 + F.col("pos") % 3), asset))


@query(
    "expand_children",
    sql(EVENTS, LATEST, ASSETS, """
      SELECT record_id, CAST(0 AS INT) AS step, 'expanded' AS event, CAST(NULL AS VARCHAR) AS parent_record_id, n AS child_count,
        array_to_string(list_transform(generate_series(1, n), lambda i: record_id || '--rnz-' || i), ' ') AS children,
        CAST(NULL AS VARCHAR) AS source_url, retry_count FROM assets WHERE n > 1
      UNION ALL
      SELECT record_id || '--rnz-' || i, CAST(i AS INT), 'discovered', record_id, NULL, NULL, base || i, 0
      FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM assets WHERE n > 1) c"""),
)
def expand_children(spark, sf):
    expanded = archive.expand_children(items_with_assets(spark, sf))
    return expanded.select(
        "record_id", "step", "event", "parent_record_id", "child_count",
        F.array_join("child_record_ids", " ").alias("children"), "source_url", "retry_count",
    )


@query("child_record_id", sql(EVENTS, "SELECT event_id, record_id || '--rnz-' || CAST(retry_count AS VARCHAR) AS child FROM manifest_events"))
def child_record_id(spark, sf):
    return manifest_events(spark, sf).select(
        "event_id", archive.child_record_id(F.col("record_id"), F.col("retry_count").cast("string")).alias("child")
    )


QUOTAS = {"src0": 41, "src1": 41, "src2": 40, "src3": 40}
DISCOVERED = """quotas AS (SELECT * FROM (VALUES ('src0', 41), ('src1', 41), ('src2', 40), ('src3', 40)) q(name, quota)),
known AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events)"""


@query(
    "discover_new",
    sql(RECORDS, DISCOVERED, """ranked AS (
      SELECT r.*, q.quota, row_number() OVER (PARTITION BY primary_collection ORDER BY pos) AS rank FROM records r JOIN quotas q ON r.primary_collection = q.name)""",
        """SELECT id AS record_id, pos, 'discovered' AS event, primary_collection AS collection, title, object_url[1] AS source_url,
             CAST(0 AS BIGINT) AS retry_count, primary_collection || ':' || coalesce(nullif(regexp_extract(array_to_string(coalesce(date, []), ' '), '\\b((18|19|20)\\d{2})\\b', 1), ''), '') AS stratum
           FROM ranked WHERE rank <= quota AND id NOT IN (SELECT id FROM known)"""),
)
def discover_new(spark, sf):
    quotas = archive.balanced_quotas(sum(QUOTAS.values()), list(QUOTAS))
    found = archive.discover_new(records(spark, sf), manifest_events(spark, sf), quotas, DOMAINS, url_columns=["object_url"])
    year = F.coalesce(F.col("pilot_stratum.year").cast("string"), F.lit(""))
    return found.withColumn("stratum", F.concat("pilot_stratum.collection", F.lit(":"), year)).drop("pilot_stratum")


@query(
    "discover_new_refill",
    sql(RECORDS, DISCOVERED, """ranked AS (
      SELECT r.*, q.quota, row_number() OVER (PARTITION BY primary_collection ORDER BY pos) AS rank FROM records r JOIN quotas q ON r.primary_collection = q.name
      WHERE id NOT IN (SELECT id FROM known))""",
        "SELECT id AS record_id, pos, primary_collection AS collection FROM ranked WHERE rank <= quota"),
)
def discover_new_refill(spark, sf):
    found = archive.discover_new(records(spark, sf), manifest_events(spark, sf), QUOTAS, DOMAINS, refill=True, url_columns=["object_url"])
    return found.select("record_id", "pos", "collection")


@query(
    "discover_one",
    sql(RECORDS, """SELECT id AS record_id, 'discovered' AS event, primary_collection AS collection, title, object_url[1] AS source_url,
      CAST(0 AS BIGINT) AS retry_count, true AS reprocess_requested FROM records WHERE id = '8' AND primary_collection = 'src8'"""),
)
def discover_one(spark, sf):
    events = manifest_events(spark, sf)
    return archive.discover_one(records(spark, sf), events, "8", ["src8"], DOMAINS, reprocess=True, url_columns=["object_url"])


@query(
    "balanced_quotas",
    """WITH labels AS (SELECT source AS label, row_number() OVER (ORDER BY source) - 1 AS place FROM (SELECT DISTINCT source FROM documents) s)
       SELECT label, place, CAST(floor(100 / (SELECT count(*) FROM labels)) AS BIGINT)
         + CASE WHEN place < 100 % (SELECT count(*) FROM labels) THEN 1 ELSE 0 END AS quota FROM labels""",
)
def balanced_quotas(spark, sf):
    labels = row_index(table(spark, sf, "documents").select(F.col("source").alias("label")).distinct(), ["label"], "place")
    return archive.quota_table(labels, 100)


REASONS = """review AS (
  SELECT event_id, list_filter([CASE WHEN retry_count >= 3 THEN 'many_retries' END, CASE WHEN duration_seconds < 5 THEN 'short' END], lambda x: x IS NOT NULL) AS quality,
    list_filter([CASE WHEN review_required THEN 'caller' END], lambda x: x IS NOT NULL) AS sensitive FROM manifest_events)"""


@query(
    "review_queue",
    sql(EVENTS, REASONS, """
      SELECT event_id, array_to_string(list_concat(list_transform(quality, lambda x: 'quality:' || x), list_transform(sensitive, lambda x: 'sensitive:' || x)), ',') AS reasons,
        len(quality) + len(sensitive) > 0 AS required, CASE WHEN len(quality) + len(sensitive) > 0 THEN 'pending' ELSE 'not_required' END AS status FROM review"""),
)
def review_queue(spark, sf):
    events = manifest_events(spark, sf).select(
        "event_id",
        flags((F.col("retry_count") >= 3, "many_retries"), (F.col("duration_seconds") < 5, "short")).alias("quality_flags"),
        flags((F.col("review_required"), "caller")).alias("sensitive_review_signals"),
    )
    return archive.review_queue(events).select("event_id", F.array_join("reasons", ",").alias("reasons"), "required", "status")


@query(
    "review_queue_similar",
    sql(EVENTS, REASONS.replace("AS sensitive FROM", "AS sensitive, pos % 5 = 0 AS alike FROM"), """
      SELECT event_id, array_to_string(list_concat(list_transform(quality, lambda x: 'quality:' || x), CASE WHEN alike THEN ['activity_similarity_candidate'] ELSE [] END), ',') AS reasons,
        len(quality) > 0 OR alike AS required FROM review"""),
)
def review_queue_similar(spark, sf):
    events = manifest_events(spark, sf).select(
        "event_id",
        flags((F.col("retry_count") >= 3, "many_retries"), (F.col("duration_seconds") < 5, "short")).alias("quality_flags"),
        F.array().cast("array<string>").alias("sensitive_review_signals"),
        (F.col("pos") % 5 == 0).alias("similar"),
    )
    return archive.review_queue(events, similar="similar").select("event_id", F.array_join("reasons", ",").alias("reasons"), "required")


@query(
    "record_review",
    sql(EVENTS, LATEST, """
      SELECT e.record_id, e.event_id AS note, e.disposition,
        CASE WHEN e.disposition NOT IN ('approved', 'no_action') THEN 'unknown disposition'
             WHEN e.actor = '' THEN 'unauthenticated request'
             WHEN l.event IS NULL OR l.event <> 'processed' THEN 'not a processed item' END AS rejected
      FROM (SELECT *, ['approved', 'no_action', 'later'][CAST(pos % 3 AS INT) + 1] AS disposition, CASE WHEN pos % 5 = 0 THEN '' ELSE 'reviewer' END AS actor FROM manifest_events) e
      LEFT JOIN latest l ON l.record_id = e.record_id"""),
)
def record_review(spark, sf):
    events = manifest_events(spark, sf)
    requests = events.select(
        "record_id",
        F.col("event_id").alias("note"),
        F.element_at(F.lit(["approved", "no_action", "later"]), (F.col("pos") % 3 + 1).cast("int")).alias("disposition"),
        F.when(F.col("pos") % 5 == 0, " ").otherwise("reviewer").alias("actor"),
        F.lit("42").alias("github_run_id"),
    )
    return archive.record_review(requests, events).select("record_id", "note", "disposition", "rejected")


@query(
    "manifest_summary",
    sql(EVENTS, LATEST, """SELECT event, count(*) AS state_records, (SELECT count(*) FROM latest) AS records,
      (SELECT count(*) FROM latest WHERE review_required) AS review_required FROM latest GROUP BY 1"""),
)
def manifest_summary(spark, sf):
    return archive.manifest_summary(manifest_events(spark, sf))


def with_pilot_fields(events):
    return events.select(
        "*",
        F.concat(F.lit("item "), "record_id").alias("title"),
        F.lit("general").alias("collection"),
        F.struct(
            F.when(F.col("pos") % 2 == 0, F.concat(F.lit("stratum "), (F.col("pos") % 3).cast("string"))).alias("collection"),
            (F.lit(1990) + F.col("pos") % 20).alias("year"),
        ).alias("pilot_stratum"),
        F.struct(
            F.lit("en").alias("language"),
            (F.col("pos") % 4).alias("speaker_count"),
            *[
                (F.col("pos") % 8 / 8).alias(name)
                for name in ("overlap_seconds", "speech_coverage", "average_word_confidence", "rms_dbfs", "clipped_sample_ratio")
            ],
        ).alias("pilot_metrics"),
        F.lit(None).cast("array<string>").alias("quality_flags"),
    )


@query(
    "pilot_report",
    sql(EVENTS, LATEST, """SELECT record_id, 'item ' || record_id AS title,
      CASE WHEN pos % 2 = 0 THEN 'stratum ' || CAST(pos % 3 AS VARCHAR) ELSE 'general' END AS collection, 1990 + pos % 20 AS year,
      duration_seconds, 'en' AS language, pos % 4 AS speaker_count, pos % 8 / 8.0 AS overlap_seconds, pos % 8 / 8.0 AS speech_coverage,
      pos % 8 / 8.0 AS average_word_confidence, pos % 8 / 8.0 AS rms_dbfs, pos % 8 / 8.0 AS clipped_sample_ratio, review_required, CAST(0 AS INT) AS flags
      FROM latest WHERE event = 'processed'"""),
)
def pilot_report(spark, sf):
    report = archive.pilot_report(with_pilot_fields(manifest_events(spark, sf)))
    return report.select(
        "record_id", "title", "collection", "year", "duration_seconds", "language", "speaker_count", "overlap_seconds",
        "speech_coverage", "average_word_confidence", "rms_dbfs", "clipped_sample_ratio", "review_required", F.size("quality_flags").alias("flags"),
    )


@query(
    "pilot_coverage",
    sql(EVENTS, LATEST, "done AS (SELECT count(*) AS processed_count, CAST(100 AS BIGINT) AS target_count FROM latest WHERE event = 'processed')",
        f"""SELECT processed_count, target_count, {exact('least(1.0, processed_count / 100.0)', 6)} AS coverage_ratio,
              processed_count >= 100 AS manual_review_required, processed_count < 100 AS blocked FROM done"""),
)
def pilot_coverage(spark, sf):
    return evaluate.pilot_coverage(archive.pilot_header(manifest_events(spark, sf)))


@query(
    "package_shard",
    sql(EVENTS, LATEST, "packaged AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS record_id FROM customer WHERE c_acctbal > 0)", """
      SELECT 'state' AS part, record_id, pos FROM latest WHERE event = 'processed' AND record_id IN (SELECT record_id FROM packaged)
      UNION ALL SELECT 'history', record_id, pos FROM manifest_events WHERE record_id IN (SELECT record_id FROM packaged)"""),
)
def package_shard(spark, sf):
    """Customers with a positive balance stand for the packaged records."""
    packaged = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").cast("string").alias("record_id"))
    state, history = archive.package_shard(manifest_events(spark, sf).select("record_id", "pos", "event"), packaged)
    part = lambda df, name: df.select(F.lit(name).alias("part"), "record_id", "pos")
    return part(state, "state").unionByName(part(history, "history"))


@query(
    "shard_files",
    sql(EVENTS, LATEST, "packaged AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS record_id FROM customer WHERE c_acctbal > 0)", """
      SELECT 'state' AS part, record_id, event, pos FROM latest WHERE event = 'processed' AND record_id IN (SELECT record_id FROM packaged)
      UNION ALL SELECT 'history', record_id, event, pos FROM manifest_events WHERE record_id IN (SELECT record_id FROM packaged)"""),
)
def shard_files(spark, sf):
    """The state and history of a written shard, read back."""
    path = scratch_path(spark, "shard")
    packaged = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").cast("string").alias("record_id"))
    archive.write_shard(manifest_events(spark, sf).select("record_id", "event", "pos"), packaged, path, "one")
    state = spark.read.parquet(f"{path}/manifest-one.parquet")
    history = spark.read.schema("event string, pos bigint, record_id string").json(f"{path}/manifest-one.jsonl")
    part = lambda df, name: df.select(F.lit(name).alias("part"), "record_id", "event", "pos")
    return part(state, "state").unionByName(part(history, "history"))


RULES = (
    Rule("event_id", "min_length", 8),
    Rule("record_id", "pattern", "^[0-9]{1,2}$"),
    Rule("event", "enum", ("discovered", "processed")),
    Rule("retry_count", "maximum", 3),
    Rule("duration_seconds", "minimum", 1),
    Rule("review_required", "const", False),
    Rule("reason", "max_length", 16),
    Rule("media_url", "required"),
)
BROKEN = """broken AS (
  SELECT event_id AS key, 'record_id' AS field, 'pattern:^[0-9]{1,2}$' AS rule FROM manifest_events WHERE NOT regexp_matches(record_id, '^[0-9]{1,2}$')
  UNION ALL SELECT event_id, 'event', 'enum' FROM manifest_events WHERE event NOT IN ('discovered', 'processed')
  UNION ALL SELECT event_id, 'retry_count', 'maximum:3' FROM manifest_events WHERE retry_count > 3
  UNION ALL SELECT event_id, 'duration_seconds', 'minimum:1' FROM manifest_events WHERE duration_seconds < 1
  UNION ALL SELECT event_id, 'review_required', 'const:False' FROM manifest_events WHERE review_required
  UNION ALL SELECT event_id, 'reason', 'max_length:16' FROM manifest_events WHERE length(reason) > 16
  UNION ALL SELECT event_id, 'media_url', 'required' FROM manifest_events)"""


def open_events(spark, sf):
    return manifest_events(spark, sf).withColumn("media_url", F.lit(None).cast("string"))


@query("contract_violations", sql(EVENTS, BROKEN, "SELECT * FROM broken"))
def contract_violations(spark, sf):
    return contract.contract_violations(open_events(spark, sf), "event_id", RULES)


@query("contract_check", sql(EVENTS, BROKEN, "SELECT field, rule, count(*) AS violations FROM broken GROUP BY 1, 2"))
def contract_check(spark, sf):
    return contract.contract_check(open_events(spark, sf), "event_id", RULES)


@query("contract_extra_keys", "SELECT event_id AS key, 'k' AS field, 'no_extra_keys' AS rule FROM events WHERE props LIKE '%\"k\"%'")
def contract_extra_keys(spark, sf):
    return contract.extra_keys(table(spark, sf, "events"), "event_id", "props", ["known"])


FILES = ", ".join(f"'{name}'" for name in REQUIRED_ITEM_FILES)
AUDIT = f"""talks AS (
  SELECT conv_id, count(*) AS turns, CAST(sum(length(text)) AS DOUBLE) AS chars, bool_or(role = 'user') AS named FROM conversations GROUP BY 1),
items AS (SELECT CAST(c_custkey AS VARCHAR) AS record_id, turns, named FROM customer LEFT JOIN talks ON conv_id = c_custkey),
required AS (SELECT record_id, turns, unnest([{FILES}]) AS name, unnest(range(1, {len(REQUIRED_ITEM_FILES) + 1})) AS no FROM items)"""


@query(
    "asset_audit",
    sql(AUDIT, """SELECT record_id, 'missing_or_empty' AS problem, name AS detail FROM required WHERE turns IS NULL OR no > turns + 4 OR no = turns
      UNION ALL SELECT record_id, 'duration_differs', NULL FROM items WHERE turns IS NULL OR turns > 4
      UNION ALL SELECT record_id, 'no_segment_list', NULL FROM items WHERE turns IS NULL
      UNION ALL SELECT record_id, 'non_anonymous_speaker', 'KNOWN_PERSON' FROM items WHERE named"""),
)
def asset_audit(spark, sf):
    return contract.asset_audit(*audited(spark, sf))


@query(
    "verified_items",
    f"""WITH talks AS (SELECT conv_id, count(*) AS turns, CAST(sum(length(text)) AS DOUBLE) AS chars FROM conversations GROUP BY 1)
      SELECT CAST(conv_id AS VARCHAR) AS record_id, chars / 16 + turns % 5 / 2.0 AS duration, array_to_string(list_sort([{FILES}]), ',') AS outputs
      FROM talks WHERE conv_id % 4 <> 0 AND conv_id % 7 <> 0 AND turns % 5 <= 2""",
)
def verified_items(spark, sf):
    """An item per conversation; some lack a file, differ in duration or name a speaker."""
    turns = table(spark, sf, "conversations").withColumn("record_id", F.col("conv_id").cast("string"))
    talks = turns.groupBy("record_id", "conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text")).alias("chars"))
    names = talks.select("record_id", "conv_id", F.explode(F.lit(list(REQUIRED_ITEM_FILES))).alias("name"))
    lost = (F.col("conv_id") % 4 == 0) & (F.col("name") == REQUIRED_ITEM_FILES[-1])
    files = names.select("record_id", "name", F.when(lost, 0).otherwise(1).alias("length"))
    seconds = F.col("chars") / 16
    items = talks.select("record_id", seconds.alias("expected_duration"), (seconds + F.col("turns") % 5 / 2).alias("actual_duration"))
    speaker = F.when(F.col("conv_id") % 7 == 0, "KNOWN_PERSON").otherwise("SPEAKER_03")
    found = contract.verified_items(items, files, turns.select("record_id", speaker.alias("speaker")))
    return found.withColumn("outputs", F.array_join("outputs", ","))


def audited(spark, sf):
    """An item per customer; the conversation of the same number gives its files, durations and speakers."""
    turns = table(spark, sf, "conversations").withColumn("record_id", F.col("conv_id").cast("string"))
    talks = turns.groupBy("record_id").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text")).alias("chars"))
    names = F.slice(F.lit(list(REQUIRED_ITEM_FILES)), F.lit(1), F.col("turns").cast("int") + 4)
    listed = talks.select("record_id", "turns", "chars", F.posexplode(names).alias("no", "name"))
    files = listed.select("record_id", "name", F.when(F.col("no") + 1 == F.col("turns"), 0).otherwise(F.col("chars")).alias("length"))
    seconds = F.col("chars") / 16
    items = (
        table(spark, sf, "customer")
        .select(F.col("c_custkey").cast("string").alias("record_id"))
        .join(talks, "record_id", "left")
        .select("record_id", seconds.alias("expected_duration"), (seconds + F.col("turns") / 4).alias("actual_duration"))
    )
    speaker = F.when(F.col("role") == "user", "KNOWN_PERSON").otherwise("SPEAKER_03")
    return items, files, turns.select("record_id", speaker.alias("speaker"))


def folded_words(text: str) -> str:
    folded = f"replace(lower({text}), 'ß', 'ss')"
    return f"list_filter(string_split(trim(regexp_replace({folded}, '\\s+', ' ', 'g')), ' '), lambda w: w <> '')"


@query(
    "word_error_rate",
    sql(PAIRS, f"words AS (SELECT id, {folded_words('reference')} AS r, {folded_words('predicted')} AS p FROM pairs)",
        f"""SELECT id, {exact('''(abs(len(r) - len(p)) + len(list_filter(list_zip(r, p, true), lambda z: z[1] <> z[2]))) / CAST(greatest(1, len(r)) AS DOUBLE)''', 6)} AS word_error_rate FROM words"""),
)
def word_error_rate(spark, sf):
    return evaluate.word_error_rate(transcript_pairs(spark, sf)).select("id", "word_error_rate")


@query("sequence_similarity")
def sequence_similarity(spark, sf):
    return evaluate.sequence_similarity(transcript_pairs(spark, sf)).select("id", "sequence_similarity")


POINTS = """expected AS (SELECT event_type AS id, CAST(user_id * 7 AS DOUBLE) / 4 AS point FROM events),
predicted AS (SELECT event_type AS id, value AS point FROM events)"""
SCORES = """scores AS (
  SELECT id, p.matched / CAST(greatest(1, p.n) AS DOUBLE) AS precision, p.matched / CAST(greatest(1, e.n) AS DOUBLE) AS recall
  FROM (SELECT id, count(*) AS n, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM expected e WHERE e.id = predicted.id AND abs(e.point - predicted.point) <= 0.25)) AS matched FROM predicted GROUP BY 1) p
  JOIN (SELECT id, count(*) AS n FROM expected GROUP BY 1) e USING (id))"""


@query(
    "boundary_score",
    sql(POINTS, SCORES, f"""SELECT id, {exact('precision', 6)} AS precision, {exact('recall', 6)} AS recall,
      {exact('2 * precision * recall / greatest(1e-9, precision + recall)', 6)} AS f1 FROM scores"""),
)
def boundary_score(spark, sf):
    events = table(spark, sf, "events")
    expected = events.select(F.col("event_type").alias("id"), (F.col("user_id") * 7 / 4).alias("point"))
    predicted = events.select(F.col("event_type").alias("id"), F.col("value").alias("point"))
    return evaluate.boundary_score(expected, predicted, 0.25)
