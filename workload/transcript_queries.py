"""Transcript analysis, enrichment, captions and sample measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.fixed_values import (
    ANALYSIS_LIMITATIONS,
    CORRECTIONS,
    MAORI_TERMS,
    PACIFIC_TERMS,
    SECTION_TERMS,
    SENSITIVE_TERMS,
    TOPIC_TERMS,
)
from stackroom.functions.text import phonetic_key
from stackroom.operators import enrichment, signal, transcript
from stackroom.runtime import materialised, scratch_path
from stackroom.sinks import captions
from workload.catalog import exact, query
from workload.views import (
    ACTIVITY,
    DIARIZATION,
    DURATIONS,
    SAMPLE_WINDOW,
    SAMPLES,
    SEGMENTS,
    SPOKEN,
    diarization,
    durations,
    pcm_samples,
    segments,
    sql,
    table,
)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def has_any(column: str, terms) -> str:
    return "(" + " OR ".join(f"contains({column}, {text(t)})" for t in terms) + ")"


def label_list(column: str, groups) -> str:
    tests = ", ".join(f"CASE WHEN {has_any(column, terms)} THEN '{name}' END" for name, terms in groups.items())
    return f"array_to_string(list_filter([{tests}], lambda x: x IS NOT NULL), ',')"


JOINED = "joined AS (SELECT recording_id, string_agg(norm, ' ' ORDER BY segment) AS full_text FROM spoken GROUP BY 1)"
LAGGED = """lagged AS (
  SELECT *, lag(norm) OVER w AS before, lag(end_s) OVER w AS before_end FROM spoken WINDOW w AS (PARTITION BY recording_id ORDER BY segment))"""
OPENINGS = """openings AS (
  SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY segment) - 1 AS chapter FROM lagged
  WHERE before_end IS NULL OR start_s - before_end >= 5.0)"""
COVERAGE = """coverage AS (
  SELECT d.recording_id, CASE WHEN duration > 0 THEN least(1.0, coalesce(s.seconds, 0.0) / duration) ELSE 0.0 END AS coverage
  FROM durations d LEFT JOIN (SELECT recording_id, sum(greatest(end_s - start_s, 0.0)) AS seconds FROM spoken GROUP BY 1) s USING (recording_id))"""
CONFIDENCE = """confidence AS (
  SELECT recording_id, CAST(sum(CAST(score AS DECIMAL(18, 12))) AS DOUBLE) / count(*) AS confidence FROM (SELECT recording_id, unnest(scores) AS score FROM spoken) s GROUP BY 1)"""
REPEATS = """repeats AS (
  SELECT recording_id, count(*) FILTER (WHERE norm <> '' AND norm = before) AS adjacent_repeated_segments FROM lagged GROUP BY 1)"""
OVERLAPS = """peaks AS (
  SELECT *, greatest(0.0, coalesce(max(end_s) OVER (PARTITION BY recording_id ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS peak FROM diarization),
overlapping AS (SELECT recording_id, sum(greatest(0.0, least(peak, end_s) - start_s)) AS seconds FROM peaks GROUP BY 1)"""
MARKERS = f"""markers AS (
  SELECT recording_id, CAST(sum(len(list_filter(string_split(norm, ' '), lambda w: w IN ({', '.join(text(t) for t in MAORI_TERMS)})))) AS BIGINT) AS maori_marker_count
  FROM spoken GROUP BY 1)"""


@query("speech_coverage", sql(SEGMENTS, DURATIONS, SPOKEN, COVERAGE, f"SELECT recording_id, {exact('coverage', 6)} AS speech_coverage FROM coverage"))
def speech_coverage(spark, sf):
    return transcript.speech_coverage(segments(spark, sf), durations(spark, sf))


@query("word_confidence", sql(SEGMENTS, SPOKEN, CONFIDENCE, f"SELECT recording_id, {exact('confidence', 6)} AS average_word_confidence FROM confidence"))
def word_confidence(spark, sf):
    return transcript.word_confidence(segments(spark, sf))


@query("adjacent_repeats", sql(SEGMENTS, SPOKEN, LAGGED, REPEATS, "SELECT * FROM repeats"))
def adjacent_repeats(spark, sf):
    return transcript.adjacent_repeats(segments(spark, sf))


@query("speaker_count", sql(SEGMENTS, DIARIZATION, "SELECT recording_id, count(DISTINCT nullif(speaker, '')) AS speaker_count FROM diarization GROUP BY 1"))
def speaker_count(spark, sf):
    return transcript.speaker_count(diarization(spark, sf))


@query("overlap_seconds", sql(SEGMENTS, DIARIZATION, OVERLAPS, f"SELECT recording_id, {exact('seconds', 3)} AS overlap_seconds FROM overlapping"))
def overlap_seconds(spark, sf):
    return transcript.overlap_seconds(diarization(spark, sf))


@query("topic_tags", sql(SEGMENTS, SPOKEN, JOINED, f"SELECT recording_id, {label_list('full_text', TOPIC_TERMS)} AS topics FROM joined"))
def topic_tags(spark, sf):
    return transcript.topic_tags(segments(spark, sf)).select("recording_id", F.array_join("topics", ",").alias("topics"))


SIGNAL_LIST = label_list("' ' || full_text || ' '", SENSITIVE_TERMS)


@query("sensitive_signals", sql(SEGMENTS, SPOKEN, JOINED, f"SELECT recording_id, {SIGNAL_LIST} AS signals FROM joined"))
def sensitive_signals(spark, sf):
    found = transcript.sensitive_signals(segments(spark, sf))
    return found.select("recording_id", F.array_join("sensitive_review_signals", ",").alias("signals"))


@query(
    "section_hints",
    sql(SEGMENTS, "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT recording_id, segment, '{kind}' AS type, start_s AS start, trim(text) AS text FROM segments WHERE {has_any('lower(text)', terms)}"
        for kind, terms in SECTION_TERMS.items()) + ") h"),
)
def section_hints(spark, sf):
    return transcript.section_hints(segments(spark, sf)).drop("kind_no")


@query("maori_marker_count", sql(SEGMENTS, SPOKEN, MARKERS, "SELECT recording_id, coalesce(maori_marker_count, 0) AS maori_marker_count FROM (SELECT DISTINCT recording_id FROM segments) r LEFT JOIN markers USING (recording_id)"))
def maori_marker_count(spark, sf):
    return transcript.maori_marker_count(segments(spark, sf))


@query(
    "chapters",
    sql(SEGMENTS, SPOKEN, LAGGED, OPENINGS, """SELECT recording_id, segment, chapter, start_s AS start, substr(clean, 1, 120) AS title,
      CASE WHEN before_end IS NULL THEN 'recording_start' ELSE 'speech_after_pause' END AS basis FROM openings"""),
)
def chapters(spark, sf):
    return transcript.chapters(segments(spark, sf))


REPORT = f"""report AS (
  SELECT d.recording_id, coverage, confidence, coalesce(adjacent_repeated_segments, 0) AS adjacent_repeated_segments,
    coalesce(maori_marker_count, 0) AS maori_marker_count, coalesce(n_chapters, 0) AS chapter_count,
    {label_list('full_text', TOPIC_TERMS)} AS topics, {SIGNAL_LIST} AS signals, s.seconds
  FROM durations d JOIN coverage USING (recording_id) LEFT JOIN confidence USING (recording_id) LEFT JOIN repeats USING (recording_id)
  LEFT JOIN markers USING (recording_id) LEFT JOIN joined USING (recording_id) LEFT JOIN overlapping s USING (recording_id)
  LEFT JOIN (SELECT recording_id, count(*) AS n_chapters FROM openings GROUP BY 1) c USING (recording_id))"""
FLAG_LIST = """array_to_string(list_filter([CASE WHEN coverage < 0.1 THEN 'possible_music_or_non_speech' END,
  CASE WHEN confidence < 0.65 THEN 'low_word_confidence' END, CASE WHEN adjacent_repeated_segments >= 3 THEN 'repetition_detected' END,
  CASE WHEN chapter_count = 0 THEN 'no_speech_segments' END,
  CASE WHEN maori_marker_count > 0 THEN 'maori_language_or_names_review_recommended' END], lambda x: x IS NOT NULL), ',')"""
PARTS = (SEGMENTS, DURATIONS, DIARIZATION, SPOKEN, JOINED, LAGGED, OPENINGS, COVERAGE, CONFIDENCE, REPEATS, OVERLAPS, MARKERS, REPORT)


@query("quality_flags", sql(*PARTS, f"SELECT recording_id, {FLAG_LIST} AS quality_flags FROM report"))
def quality_flags(spark, sf):
    found = transcript.quality_flags(segments(spark, sf), durations(spark, sf), diarization(spark, sf))
    return found.select("recording_id", F.array_join("quality_flags", ",").alias("quality_flags"))


AUDIO_FLAGS = FLAG_LIST.replace(
    "'maori_language_or_names_review_recommended' END]",
    """'maori_language_or_names_review_recommended' END, CASE WHEN recording_id % 3 = 2 THEN 'clipping_detected' END,
  CASE WHEN recording_id % 5 = 4 THEN 'mostly_near_silence' END]""",
)


@query("quality_flags_audio", sql(*PARTS, f"SELECT recording_id, {AUDIO_FLAGS} AS quality_flags FROM report"))
def quality_flags_audio(spark, sf):
    """Flags with sample measures, which follow from the recording's number."""
    lengths, number = durations(spark, sf), F.col("recording_id")
    audio = lengths.select(
        "recording_id", (number % 3 / 1000).alias("clipped_sample_ratio"), (number % 5 / 5 + 0.15).alias("near_silence_ratio")
    )
    found = transcript.quality_flags(segments(spark, sf), lengths, diarization(spark, sf), audio)
    return found.select("recording_id", F.array_join("quality_flags", ",").alias("quality_flags"))


@query(
    "analysis_report",
    sql(*PARTS, f"""SELECT recording_id, {exact('coverage', 6)} AS speech_coverage, {exact('confidence', 6)} AS average_word_confidence,
      adjacent_repeated_segments, {exact('seconds', 3)} AS overlap_seconds, coalesce(topics, '') AS topics, chapter_count, {FLAG_LIST} AS quality_flags,
      maori_marker_count, coalesce(signals, '') AS signals FROM report"""),
)
def analysis_report(spark, sf):
    report = transcript.analysis_report(segments(spark, sf), durations(spark, sf), diarization(spark, sf))
    return report.select(
        "recording_id", "speech_coverage", "average_word_confidence", "adjacent_repeated_segments", "overlap_seconds",
        F.array_join("topics", ",").alias("topics"), "chapter_count", F.array_join("quality_flags", ",").alias("quality_flags"),
        "maori_marker_count", F.array_join("sensitive_review_signals", ",").alias("signals"),
    )


LIMITS = "|".join(ANALYSIS_LIMITATIONS)


@query(
    "analysis_document",
    sql(*PARTS, "voices AS (SELECT recording_id, count(DISTINCT nullif(speaker, '')) AS n FROM diarization GROUP BY 1)",
        f"""SELECT recording_id, coalesce(n, 0) AS speaker_count, {text(LIMITS)} AS limitations, chapter_count, {FLAG_LIST} AS quality_flags
        FROM report LEFT JOIN voices USING (recording_id)"""),
)
def analysis_document(spark, sf):
    """The report's number of voices and its fixed sentences."""
    report = transcript.analysis_report(segments(spark, sf), durations(spark, sf), diarization(spark, sf))
    return report.select(
        "recording_id", "speaker_count", F.array_join("limitations", "|").alias("limitations"), "chapter_count",
        F.array_join("quality_flags", ",").alias("quality_flags"),
    )


def groups_of(letters: str) -> str:
    return f"translate({letters}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202')"


def phonetic(word: str) -> str:
    """SQL of the phonetic key of an upper-case ASCII word."""
    codes = groups_of(word)
    for digit in "0123456":
        codes = f"regexp_replace({codes}, '{digit}+', '{digit}', 'g')"
    return f"rpad(substr({word}, 1, 1) || replace(substr({codes}, 2), '0', ''), 4, '0')[1:4]"


ENTRIES = f"""entries AS (
  SELECT recording_id, segment, start_s AS start, end_s AS "end", trim(text) AS text,
    trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '\\s+', ' ', 'g')) AS normalized,
    list_sort(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z]+'), lambda w: {phonetic('upper(w)')}))) AS phonetic_terms
  FROM segments)"""


@query("search_entries", sql(SEGMENTS, ENTRIES, "SELECT * EXCLUDE (phonetic_terms), array_to_string(phonetic_terms, ' ') AS phonetic_terms FROM entries"))
def search_entries(spark, sf):
    entries = enrichment.search_entries(segments(spark, sf))
    return entries.withColumn("phonetic_terms", F.array_join("phonetic_terms", " "))


@query("phonetic_key", f"SELECT item_id, n, {phonetic('upper(word)')} AS key FROM (SELECT item_id, unnest(range(1, len(words) + 1)) AS n, unnest(words) AS word FROM (SELECT item_id, regexp_extract_all(text, '[A-Za-z]+') AS words FROM benchmark) b) w")
def phonetic_keys(spark, sf):
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    rows = table(spark, sf, "benchmark").select("item_id", F.posexplode(words).alias("n", "word"))
    return rows.select("item_id", (F.col("n") + 1).cast("bigint").alias("n"), phonetic_key(F.col("word")).alias("key"))


MAORI_HIT = f"""list_has_any(string_split(regexp_replace(lower(trim(text)), '[^\\p{{L}}\\p{{N}}_'']+', ' ', 'g'), ' '),
  [{', '.join(text(t) for t in MAORI_TERMS)}])"""
PACIFIC_HIT = has_any("lower(text)", PACIFIC_TERMS)


@query(
    "language_signals",
    sql(SEGMENTS, f"marked AS (SELECT recording_id, segment, start_s AS start, {MAORI_HIT} AS maori, {PACIFIC_HIT} AS pacific FROM segments)",
        """SELECT recording_id, segment, start, array_to_string(list_filter([CASE WHEN maori THEN 'possible_te_reo_maori_or_names' END,
             CASE WHEN pacific THEN 'possible_pacific_language' END], lambda x: x IS NOT NULL), ',') AS signals FROM marked WHERE maori OR pacific"""),
)
def language_signals(spark, sf):
    found = enrichment.language_signals(segments(spark, sf))
    return found.withColumn("signals", F.array_join("signals", ","))


SUMMARIES = """spans AS (
  SELECT recording_id, chapter, start_s AS start, lead(start_s) OVER (PARTITION BY recording_id ORDER BY chapter) AS until FROM openings),
cited AS (
  SELECT s.recording_id, s.chapter, s.start, min(e.segment) AS segment FROM spans s JOIN spoken e
  ON e.recording_id = s.recording_id AND e.start_s >= s.start AND (s.until IS NULL OR e.start_s < s.until) GROUP BY 1, 2, 3)"""


@query(
    "chapter_summaries",
    sql(SEGMENTS, SPOKEN, LAGGED, OPENINGS, SUMMARIES,
        "SELECT c.recording_id, c.chapter, c.start, substr(e.clean, 1, 280) AS text, c.segment AS cited FROM cited c JOIN spoken e USING (recording_id, segment)"),
)
def chapter_summaries(spark, sf):
    found = enrichment.chapter_summaries(segments(spark, sf))
    return found.select("recording_id", "chapter", "start", "text", F.element_at("cited_segments", 1).alias("cited"))


def corrected(column: str) -> str:
    for source, target in CORRECTIONS.items():
        # The boundary class of RE2 is ASCII, so neighbours are matched and put back; twice for adjacent words.
        for _ in range(2):
            column = f"regexp_replace({column}, '(^|[^\\p{{L}}\\p{{N}}_])(?i:{source})($|[^\\p{{L}}\\p{{N}}_])', '\\1{target}\\2', 'g')"
    return column


def applied(column: str) -> str:
    """The dictionary entries found, each in the text as the entries before it left it."""
    found = []
    for source, target in CORRECTIONS.items():
        pattern = f"(^|[^\\p{{L}}\\p{{N}}_])(?i:{source})($|[^\\p{{L}}\\p{{N}}_])"
        found.append(f"CASE WHEN regexp_matches({column}, '{pattern}') THEN '{source}' END")
        for _ in range(2):
            column = f"regexp_replace({column}, '{pattern}', '\\1{target}\\2', 'g')"
    return f"array_to_string(list_filter([{', '.join(found)}], lambda x: x IS NOT NULL), ',')"


FIXED = f"""fixed AS (
  SELECT recording_id, segment, start_s AS start, end_s AS "end", trim(text) AS original, {corrected('trim(text)')} AS corrected FROM segments)"""
NAME = "[A-ZĀĒĪŌŪ](?:[\\p{L}\\p{N}_]|[''-])+"
ENTITIES = f"""entities AS (
  SELECT DISTINCT recording_id, unnest(regexp_extract_all(trim(text), '(?:^|[^\\p{{L}}\\p{{N}}_])({NAME}(?:\\s+{NAME}){{0,3}})', 1)) AS text,
    start_s AS start FROM segments)"""


@query("entity_candidates", sql(SEGMENTS, ENTITIES, "SELECT *, 'unresolved_candidate' AS status FROM entities"))
def entity_candidates(spark, sf):
    return enrichment.entity_candidates(segments(spark, sf))


@query(
    "corrections",
    sql(SEGMENTS, FIXED,
        f"SELECT *, {applied('original')} AS applied, 'review_required' AS confidence FROM fixed WHERE corrected <> original"),
)
def corrections(spark, sf):
    found = enrichment.corrections(segments(spark, sf))
    sources = F.transform("corrections", lambda c: c["source"])
    return found.withColumn("applied", F.array_join(sources, ",")).drop("corrections")


FUZZY = "Wellington Radio"


def entry_table(spark, sf):
    """The search entries as a written table, made once and searched often."""
    return materialised(enrichment.search_entries(segments(spark, sf)))


@query(
    "fuzzy_search_phonetic",
    sql(SEGMENTS, ENTRIES, f"""hits AS (
      SELECT *, contains(normalized, '{FUZZY.lower()}') AS is_exact FROM entries
      WHERE contains(normalized, '{FUZZY.lower()}') OR list_has_any(phonetic_terms, ['W452', 'R300']))""",
        """SELECT recording_id, segment, start, "end", text, CASE WHEN is_exact THEN 'exact' ELSE 'phonetic' END AS match,
             CAST(CASE WHEN is_exact THEN 1.0 ELSE 0.9 END AS DOUBLE) AS score FROM hits"""),
)
def fuzzy_search_phonetic(spark, sf):
    """The exact and phonetic arms over all entries."""
    found = enrichment.fuzzy_matches(entry_table(spark, sf), FUZZY)
    return found.filter(F.col("match") != "fuzzy")


@query("fuzzy_search")
def fuzzy_search(spark, sf):
    return enrichment.fuzzy_search(entry_table(spark, sf), "Kia aro koutuu", 20)


@query(
    "enrichment_report",
    sql(SEGMENTS, SPOKEN, LAGGED, OPENINGS, SUMMARIES, ENTITIES, FIXED, f"""parts AS (
      SELECT recording_id, 'l' AS part FROM segments WHERE {MAORI_HIT} OR {PACIFIC_HIT}
      UNION ALL SELECT recording_id, 'e' FROM entities UNION ALL SELECT recording_id, 's' FROM segments
      UNION ALL SELECT recording_id, 'c' FROM cited UNION ALL SELECT recording_id, 'o' FROM fixed WHERE corrected <> original)""",
        """SELECT recording_id, count(*) FILTER (WHERE part = 'l') AS language_review_signals, count(*) FILTER (WHERE part = 'e') AS entity_candidates,
             count(*) FILTER (WHERE part = 's') AS search_entries, count(*) FILTER (WHERE part = 'c') AS chapter_summaries,
             count(*) FILTER (WHERE part = 'o') AS orthographic_corrections FROM parts GROUP BY 1"""),
)
def enrichment_report(spark, sf):
    return enrichment.enrichment_report(segments(spark, sf)).drop("limitations")


TIME = """lpad(CAST(ms // 3600000 AS VARCHAR), 2, '0') || ':' || lpad(CAST(ms // 60000 % 60 AS VARCHAR), 2, '0') || ':' ||
  lpad(CAST(ms // 1000 % 60 AS VARCHAR), 2, '0')"""


def caption(ms: str, separator: str) -> str:
    return TIME.replace("ms", f"({ms})") + f" || '{separator}' || lpad(CAST(({ms}) % 1000 AS VARCHAR), 3, '0')"


TIMED = """timed AS (SELECT recording_id, segment, '[' || speaker || '] ' || trim(text) AS plain,
  CAST(round_even(start_s * 1000, 0) AS BIGINT) AS a, CAST(round_even(end_s * 1000, 0) AS BIGINT) AS b FROM segments)"""


@query(
    "caption_table",
    sql(SEGMENTS, TIMED, f"""blocks AS (SELECT recording_id, {caption('a', '.')} || ' --> ' || {caption('b', '.')} || chr(10) || plain || chr(10) AS vtt FROM timed
      UNION ALL SELECT DISTINCT recording_id, 'WEBVTT' || chr(10) FROM timed)""",
        "SELECT recording_id, line, count(*) AS times FROM (SELECT recording_id, unnest(string_split(vtt, chr(10))) AS line FROM blocks) l GROUP BY 1, 2"),
)
def caption_table(spark, sf):
    """The lines of all written captions."""
    path = scratch_path(spark, "captions")
    captions.write_caption_table(segments(spark, sf), path, "vtt")
    lines = spark.read.parquet(path).select("recording_id", F.explode(F.split("value", "\n")).alias("line"))
    return lines.groupBy("recording_id", "line").agg(F.count(F.lit(1)).alias("times"))


@query(
    "captions",
    sql(SEGMENTS, TIMED,
        f"""SELECT recording_id, segment, plain, CAST(segment + 1 AS VARCHAR) || chr(10) || {caption('a', ',')} || ' --> ' || {caption('b', ',')} || chr(10) || plain || chr(10) AS srt,
              {caption('a', '.')} || ' --> ' || {caption('b', '.')} || chr(10) || plain || chr(10) AS vtt FROM timed"""),
)
def caption_rows(spark, sf):
    return captions.captions(segments(spark, sf))


@query(
    "rttm",
    sql(SEGMENTS, DIARIZATION, """SELECT recording_id, segment, 'SPEAKER ' || CAST(recording_id AS VARCHAR) || ' 1 ' || format('{:.3f}', start_s) || ' ' ||
      format('{:.3f}', end_s - start_s) || ' <NA> <NA> ' || speaker || ' <NA> <NA>' AS line FROM diarization"""),
)
def rttm(spark, sf):
    return captions.rttm(diarization(spark, sf))


@query("activity_segments", sql(SAMPLES, ACTIVITY, "SELECT * FROM activity"))
def activity_segments(spark, sf):
    return signal.activity_segments(pcm_samples(spark, sf), SAMPLE_WINDOW)


@query(
    "audio_quality",
    sql(SAMPLES, f"""levels AS (SELECT recording_id, count(*) AS n, sqrt(CAST(sum(CAST(v AS BIGINT) * v) AS DOUBLE) / count(*)) AS rms,
      count(*) FILTER (WHERE abs(v) >= 32760) AS clipped, count(*) FILTER (WHERE abs(v) <= 32) AS silent FROM pcm_samples GROUP BY 1)""",
        f"""SELECT o.o_orderkey AS recording_id, coalesce(n, 0) AS sample_count, {exact('20 * log10(rms / 32768)', 3)} AS rms_dbfs,
              coalesce({exact('clipped / CAST(n AS DOUBLE)', 8)}, 0.0) AS clipped_sample_ratio, coalesce({exact('silent / CAST(n AS DOUBLE)', 8)}, 1.0) AS near_silence_ratio
            FROM orders o LEFT JOIN levels l ON l.recording_id = o.o_orderkey"""),
)
def audio_quality(spark, sf):
    """Every order key stands for a recording; most of them have no samples."""
    recordings = table(spark, sf, "orders").select(F.col("o_orderkey").alias("recording_id"))
    return signal.audio_quality(pcm_samples(spark, sf), recordings)


@query(
    "activity_fingerprint",
    sql(SAMPLES, ACTIVITY, """SELECT recording_id, sha256(string_agg(label || ':' || format('{:.1f}', CASE WHEN coalesce(rms_dbfs, 0.0) = 0 THEN -99.0 ELSE rms_dbfs END), '|' ORDER BY "window")) AS activity_fingerprint,
      CAST(NULL AS VARCHAR) AS rejected FROM activity GROUP BY 1"""),
)
def activity_fingerprint(spark, sf):
    return signal.activity_fingerprint(signal.activity_segments(pcm_samples(spark, sf), SAMPLE_WINDOW))
