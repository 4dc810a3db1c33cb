"""Record, segment, event, sample and page views derived from the given tables, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOMAINS = ("example.com", "example.org")
MUSEUM = "archive.example.org"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def records(spark: SparkSession, sf: str) -> DataFrame:
    """A heritage record per document: title is the first line, description the whole text."""
    docs = table(spark, sf, "documents")
    n = F.col("doc_id")
    year = (F.lit(1840) + n % 180).cast("string")
    undated = n % 10 == 0
    link = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/item/"), n.cast("string"))
    return docs.select(
        n.alias("pos"),
        n.cast("string").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("description"),
        F.array("source").alias("collection"),
        F.col("source").alias("primary_collection"),
        F.array(F.concat(F.lit("partner-"), (n % 7).cast("string"))).alias("content_partner"),
        F.array("lang", "source").alias("category"),
        F.when(~undated, F.array(F.concat(F.lit("12 May "), year))).alias("date"),
        F.when(~undated, F.array(year)).alias("year"),
        F.when(n % 3 == 0, "Share").when(n % 3 == 1, "Modify").otherwise("All rights reserved").alias("usage"),
        ((n * 7) % 181 - 90).cast("double").alias("lat"),
        ((n * 13) % 361 - 180).cast("double").alias("lon"),
        "n_chars",
        F.when(n % 4 != 0, link).alias("source_url"),
        F.array(link, F.concat(F.lit("http://"), F.col("source"), F.lit(".example.net/"), n.cast("string"))).alias("object_url"),
    )


RECORDS = """records AS (
  SELECT doc_id AS pos, CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text AS description,
    [source] AS collection, source AS primary_collection,
    ['partner-' || CAST(doc_id % 7 AS VARCHAR)] AS content_partner, [lang, source] AS category,
    CASE WHEN doc_id % 10 <> 0 THEN ['12 May ' || CAST(1840 + doc_id % 180 AS VARCHAR)] END AS date,
    CASE WHEN doc_id % 10 <> 0 THEN [CAST(1840 + doc_id % 180 AS VARCHAR)] END AS year,
    CASE WHEN doc_id % 3 = 0 THEN 'Share' WHEN doc_id % 3 = 1 THEN 'Modify' ELSE 'All rights reserved' END AS usage,
    CAST((doc_id * 7) % 181 - 90 AS DOUBLE) AS lat, CAST((doc_id * 13) % 361 - 180 AS DOUBLE) AS lon, n_chars,
    CASE WHEN doc_id % 4 <> 0 THEN 'https://' || source || '.example.com/item/' || CAST(doc_id AS VARCHAR) END AS source_url,
    ['https://' || source || '.example.com/item/' || CAST(doc_id AS VARCHAR),
     'http://' || source || '.example.net/' || CAST(doc_id AS VARCHAR)] AS object_url
  FROM documents)"""


# Broadcast phrases appended to the turns, some of them cut at a segment border.
PHRASES = [
    "Headlines from Parliament and Te",
    "Tiriti talks, Maori hapu and whānau",
    "In the weather forecast: showers. A caller discussed family",
    "violence. Joining us: iwi, marae, Hapu",
    "Talofa, Pacific listeners in Wellington",
    "Radio Welingtn, school",
    "student union; produced by Te Pāti Māori",
]


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """A transcript segment per turn and some between turns: starts every 15 s, speech as long as the text, a score per word.

    Every turn keeps its whole text with a phrase behind it. Further segments hold a repeated greeting, dots or
    blanks only.
    """
    turns = table(spark, sf, "conversations")
    start = F.col("turn").cast("double") * 15
    kind, phrase = F.col("conv_id") % 6, F.element_at(F.lit(PHRASES), (F.col("turn") % len(PHRASES) + 1).cast("int"))
    between = (
        F.when(kind == 5, "Kia ora koutou!")
        .when((kind == 4) & (F.col("turn") % 3 == 1), " ... ")
        .when((kind == 3) & (F.col("turn") % 2 == 1), "  ")
    )
    spoken = F.struct((F.col("turn") * 2).alias("turn"), F.concat("text", F.lit(" "), phrase).alias("text"))
    further = F.when(between.isNotNull(), F.struct((F.col("turn") * 2 + 1).alias("turn"), between.alias("text")))
    turns = turns.select("conv_id", "role", F.inline(F.array_compact(F.array(spoken, further))))
    words = F.transform(
        F.split("text", " "),
        lambda w: F.struct(w.alias("word"), ((F.length(w) * 37 % 101) / 100.0).cast("double").alias("score")),
    )
    return turns.select(
        F.col("conv_id").alias("recording_id"),
        F.col("turn").alias("segment"),
        F.col("role").alias("speaker"),
        "text",
        start.alias("start_s"),
        ((F.col("turn") * 15000 + F.length("text") * 60).cast("double") / 1000).alias("end_s"),
        words.alias("words"),
    )


SEGMENTS = f"""turns AS (
  SELECT conv_id, turn * 2 AS turn, role, text || ' ' || ({PHRASES!r})[CAST(turn % {len(PHRASES)} + 1 AS INT)] AS text
  FROM conversations
  UNION ALL SELECT * FROM (SELECT conv_id, turn * 2 + 1 AS turn, role, CASE WHEN conv_id % 6 = 5 THEN 'Kia ora koutou!'
    WHEN conv_id % 6 = 4 AND turn % 3 = 1 THEN ' ... ' WHEN conv_id % 6 = 3 AND turn % 2 = 1 THEN '  ' END AS text
    FROM conversations) WHERE text IS NOT NULL),
segments AS (
  SELECT conv_id AS recording_id, turn AS segment, role AS speaker, text, CAST(turn AS DOUBLE) * 15 AS start_s,
    CAST(turn * 15000 + length(text) * 60 AS DOUBLE) / 1000 AS end_s,
    list_transform(string_split(text, ' '), lambda w: (length(w) * 37 % 101) / 100.0) AS scores
  FROM turns)"""


def diarization(spark: SparkSession, sf: str) -> DataFrame:
    """Speaker turns that run one second over the segment."""
    rows = segments(spark, sf).select("recording_id", "segment", "speaker", "start_s", "end_s")
    return rows.withColumn("end_s", F.col("end_s") + 1)


DIARIZATION = """diarization AS (
  SELECT recording_id, segment, speaker, start_s, end_s + 1 AS end_s FROM segments)"""


def durations(spark: SparkSession, sf: str) -> DataFrame:
    return segments(spark, sf).groupBy("recording_id").agg(F.max("end_s").alias("duration"))


DURATIONS = """durations AS (SELECT recording_id, max(end_s) AS duration FROM segments GROUP BY recording_id)"""

# Parts that both dialects read alike.
SPOKEN = r"""spoken AS (
  SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS clean,
    trim(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', ' ', 'g')) AS norm
  FROM segments WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '')"""

EVENT_OF_TYPE = {"signup": "discovered", "view": "expanded", "click": "downloaded", "purchase": "processed"}


def manifest_events(spark: SparkSession, sf: str) -> DataFrame:
    """An archive event per event row; ``pos`` is the append order."""
    return as_manifest(table(spark, sf, "events"))


def as_manifest(events: DataFrame) -> DataFrame:
    n = F.col("event_id")
    state = F.lit("retry")
    for kind, name in EVENT_OF_TYPE.items():
        state = F.when(F.col("event_type") == kind, name).otherwise(state)
    digest = F.sha2((n % 211).cast("string"), 256)
    return events.select(
        n.alias("pos"),
        F.concat(F.lit("event-"), F.format_string("%012d", n)).alias("event_id"),
        F.col("user_id").cast("string").alias("record_id"),
        F.col("ts"),
        state.alias("event"),
        (n % 5).alias("retry_count"),
        (n % 7 == 0).alias("review_required"),
        digest.alias("normalized_sha256"),
        F.concat(F.repeat(F.lit("z"), (n % 8).cast("int")), F.substr(digest, (n % 8).cast("int") + 1)).alias("fingerprint"),
        F.col("value").alias("duration_seconds"),
        F.concat(F.lit("failed: "), F.col("props")).alias("reason"),
    )


EVENTS = """manifest_events AS (
  SELECT event_id AS pos, 'event-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id,
    CAST(user_id AS VARCHAR) AS record_id, ts,
    CASE event_type WHEN 'signup' THEN 'discovered' WHEN 'view' THEN 'expanded' WHEN 'click' THEN 'downloaded'
      WHEN 'purchase' THEN 'processed' ELSE 'retry' END AS event,
    event_id % 5 AS retry_count, event_id % 7 = 0 AS review_required,
    sha256(CAST(event_id % 211 AS VARCHAR)) AS normalized_sha256,
    repeat('z', CAST(event_id % 8 AS INT)) || substr(sha256(CAST(event_id % 211 AS VARCHAR)), CAST(event_id % 8 AS INT) + 1) AS fingerprint,
    value AS duration_seconds, 'failed: ' || props AS reason
  FROM events)"""

LATEST = """latest AS (
  SELECT * FROM manifest_events QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY pos DESC) = 1)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("vec_id")
    return table(spark, sf, "embeddings").select(n.cast("string").alias("record_id"), n.alias("pos"), "embedding", "label")


VECTORS = """vectors AS (SELECT CAST(vec_id AS VARCHAR) AS record_id, vec_id AS pos, embedding, label FROM embeddings)"""

SAMPLE_WINDOW = 16


def pcm_samples(spark: SparkSession, sf: str) -> DataFrame:
    """A recording per vector, a 16-bit sample per position."""
    level = F.floor(F.col("x").cast("double") * 32768).cast("int")
    cells = table(spark, sf, "embeddings").select(F.col("vec_id").alias("recording_id"), F.posexplode("embedding").alias("idx", "x"))
    return cells.select("recording_id", "idx", level.alias("v"))


SAMPLES = """pcm_samples AS (
  SELECT vec_id AS recording_id, idx - 1 AS idx, CAST(floor(CAST(embedding[idx] AS DOUBLE) * 32768) AS INT) AS v
  FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS idx FROM embeddings) t)"""

ACTIVITY = """activity AS (
  SELECT recording_id, w AS "window", CAST(w AS DOUBLE) AS start, w + n / 16.0 AS "end",
    CASE WHEN rms <= 32 THEN 'silence' ELSE 'activity' END AS label,
    CASE WHEN rms > 0 THEN round(20 * log10(CASE WHEN rms > 0 THEN rms END / 32768), 3) END AS rms_dbfs
  FROM (SELECT recording_id, CAST(floor(idx / 16.0) AS BIGINT) AS w, count(*) AS n,
          sqrt(CAST(sum(CAST(v AS BIGINT) * v) AS DOUBLE) / count(*)) AS rms
        FROM pcm_samples GROUP BY 1, 2) s)"""


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def media_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with the media markup a programme page would hold, by kind of address."""
    n, text = F.col("page_id"), F.col("page_id").cast("string")
    base = F.concat(F.lit("https://www.example.com/programme/audio/"), text, F.lit("/item"))
    url = F.when(n % 4 < 2, base).when(n % 4 == 2, F.col("url")).otherwise(
        F.concat(F.lit("https://media.example.org/story/"), text)
    )
    own = F.concat(F.lit("<div media='{\"id\":"), text, F.lit(',"audioSrc":"https://cdn.example.com/'), text, F.lit(".mp3\"}'></div>"))
    item = F.concat(
        F.lit("<rnz-queue-media media='{\"id\":\"m"), text,
        F.lit('","title":"Part","audioSrc":"https://cdn.example.org/'), text, F.lit(".mp3\"}'></rnz-queue-media>"),
    )
    audio = F.concat(F.lit('<audio src="/files/'), text, F.lit('.ogg?x=1"></audio>'))
    extra = F.when(n % 4 == 0, own).when(n % 4 == 1, F.concat(item, item)).when(n % 4 == 3, audio).otherwise(F.lit(""))
    return pages(spark, sf).select("page_id", url.alias("url"), F.concat("html", extra).alias("html"))


def transcript_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as the prediction of one benchmark passage, whole texts."""
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    n = items.agg(F.count(F.lit(1))).scalar()
    wanted = docs.select("doc_id", F.col("text").alias("predicted"), (F.col("doc_id") % n).alias("item_id"))
    return wanted.join(items.select("item_id", F.col("text").alias("reference")), "item_id").select(
        F.col("doc_id").alias("id"), "reference", "predicted"
    )


PAIRS = """pairs AS (
  SELECT d.doc_id AS id, b.text AS reference, d.text AS predicted
  FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id)"""


def sql(*parts: str) -> str:
    """CTEs followed by the final SELECT."""
    *ctes, final = parts
    return f"WITH {', '.join(ctes)} {final}"
