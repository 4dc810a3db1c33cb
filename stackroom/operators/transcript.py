"""Transcript analysis over segment tables.

Segments: ``recording_id, segment, start_s, end_s, text, speaker, words array<struct<word, score>>`` where
``segment`` is the list index. Diarization: ``recording_id, start_s, end_s, speaker``. Durations:
``recording_id, duration``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.fixed_values import (
    ANALYSIS_LIMITATIONS,
    CHAPTER_GAP_SECONDS,
    CHAPTER_TITLE_CHARS,
    MAORI_TERMS,
    SECTION_TERMS,
    SENSITIVE_TERMS,
    TOPIC_TERMS,
)
from stackroom.functions.arrays import flags
from stackroom.functions.numbers import let, round_exact, steady_sum
from stackroom.functions.text import SPACE, any_term, stripped, word_text
from stackroom.plans.blocks import long_keys, with_peak_before, with_position, with_previous

KEY = "recording_id"
# Every term has at most one separator inside, so a match touches at most two neighbouring segments.
BORDER_CHARS = max(len(t) for group in (TOPIC_TERMS, SENSITIVE_TERMS) for terms in group.values() for t in terms)


def _spoken(segments: DataFrame) -> DataFrame:
    return segments.filter(F.col("text").rlike(rf"(?U)[^{SPACE[1:-1]}]"))


def _digest(norm: Column) -> Column:
    return F.when(norm != "", F.sha2(norm, 256))


def _border_parts(norm: Column) -> dict[str, Column]:
    """What the neighbours and the repeat test need of a segment, instead of its whole words.

    A term that crosses a segment border lies in the tail of one segment and the head of the next.
    """
    return {
        "digest": _digest(norm),
        "head": F.substring(norm, 1, BORDER_CHARS),
        "tail": F.substring(norm, -BORDER_CHARS, BORDER_CHARS),
    }


def _repeated() -> Column:
    return F.coalesce(F.col("digest") == F.col("prev.digest"), F.lit(False))


def _crossing(tests: Column) -> Column:
    return F.coalesce(tests, F.lit(False))


def _marker_count(norm: Column) -> Column:
    return F.size(F.filter(F.split(norm, " "), lambda word: word.isin(*MAORI_TERMS)))


def _opens_chapter() -> Column:
    return F.col("prev").isNull() | (F.col("start_s") - F.col("prev.ended") >= CHAPTER_GAP_SECONDS)


def _score_sum(words: Column) -> Column:
    return F.aggregate(words, F.lit(0.0), lambda acc, w: acc + F.coalesce(w["score"].cast("double"), F.lit(0.0)))


def _score_count(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: w["score"].isNotNull()))


def spoken_metrics(segments: DataFrame) -> DataFrame:
    """All per-recording measures of the spoken segments, from one pass along each recording.

    Texts and word lists are reduced to label tests, border parts and sums before the rows are shuffled.
    """
    words = F.coalesce("words", F.expr("array()").cast("array<struct<word:string,score:double>>"))
    rows = _spoken(segments).select(
        KEY,
        "segment",
        "start_s",
        "end_s",
        "text",
        F.greatest(F.col("end_s") - F.col("start_s"), F.lit(0.0)).alias("speech"),
        _score_sum(words).alias("score_sum"),
        _score_count(words).alias("score_count"),
    )
    own = rows.withColumn("norm", word_text(F.col("text")))
    own = own.withColumn("padded", F.concat(F.lit(" "), "norm", F.lit(" ")))
    own = own.withColumns(
        {
            "markers": _marker_count(F.col("norm")),
            **{f"topic_{name}": any_term(F.col("norm"), terms) for name, terms in TOPIC_TERMS.items()},
            **{f"signal_{name}": any_term(F.col("padded"), terms) for name, terms in SENSITIVE_TERMS.items()},
            **_border_parts(F.col("norm")),
            "ended": F.col("end_s"),
        }
    )
    at_border = {**_border_parts(word_text(F.col("text"))), "ended": F.col("end_s")}
    spoken = with_previous(own, KEY, "segment", at_border, source=rows)
    # A cut-off part continues beyond its edge, so no separator may stand there.
    lead = F.when(F.length("prev.tail") < BORDER_CHARS, F.lit(" ")).otherwise(F.lit(""))
    close = F.when(F.length("head") < BORDER_CHARS, F.lit(" ")).otherwise(F.lit(""))
    spoken = spoken.withColumn("border", F.concat("prev.tail", F.lit(" "), "head")).withColumn(
        "padded_border", F.concat(lead, "border", close)
    )
    topics = [
        F.bool_or(F.col(f"topic_{n}") | _crossing(any_term(F.col("border"), t))).alias(f"topic_{n}")
        for n, t in TOPIC_TERMS.items()
    ]
    signals = [
        F.bool_or(F.col(f"signal_{n}") | _crossing(any_term(F.col("padded_border"), t))).alias(f"signal_{n}")
        for n, t in SENSITIVE_TERMS.items()
    ]
    return spoken.groupBy(KEY).agg(
        steady_sum(F.col("speech")).alias("speech_seconds"),
        steady_sum(F.col("score_sum")).alias("score_sum"),
        F.sum("score_count").alias("score_count"),
        F.count_if(_repeated()).alias("adjacent_repeated_segments"),
        F.count_if(_opens_chapter()).alias("chapter_count"),
        F.sum("markers").alias("maori_marker_count"),
        *topics,
        *signals,
    )


def _coverage() -> Column:
    share = F.least(F.lit(1.0), F.try_divide(F.coalesce("speech_seconds", F.lit(0.0)), F.col("duration")))
    return F.when(F.col("duration") > 0, share).otherwise(F.lit(0.0))


def _confidence() -> Column:
    return F.when(F.col("score_count") > 0, F.try_divide("score_sum", "score_count"))


def speech_coverage(segments: DataFrame, durations: DataFrame) -> DataFrame:
    """Share of the duration covered by spoken segments, at most 1."""
    seconds = _spoken(segments).groupBy(KEY).agg(
        steady_sum(F.greatest(F.col("end_s") - F.col("start_s"), F.lit(0.0))).alias("speech_seconds")
    )
    return durations.join(seconds, KEY, "left").select(KEY, round_exact(_coverage(), 6).alias("speech_coverage"))


def word_confidence(segments: DataFrame) -> DataFrame:
    """Mean word score per recording; null without scores."""
    words = _spoken(segments).groupBy(KEY).agg(
        steady_sum(_score_sum(F.col("words"))).alias("score_sum"), F.sum(_score_count(F.col("words"))).alias("score_count")
    )
    return words.select(KEY, round_exact(_confidence(), 6).alias("average_word_confidence"))


def adjacent_repeats(segments: DataFrame) -> DataFrame:
    rows = _spoken(segments).select(KEY, "segment", "text")
    spoken = with_previous(rows, KEY, "segment", {"digest": let(word_text(F.col("text")), _digest)})
    return spoken.groupBy(KEY).agg(F.count_if(_repeated()).alias("adjacent_repeated_segments"))


def speaker_count(diarization: DataFrame) -> DataFrame:
    return diarization.groupBy(KEY).agg(F.count_distinct(F.nullif("speaker", F.lit(""))).alias("speaker_count"))


def overlap_seconds(diarization: DataFrame) -> DataFrame:
    """Seconds in which a row starts before the latest end of the rows sorted before it."""
    spans = diarization.groupBy(KEY, "start_s", "end_s").agg(F.count(F.lit(1)).alias("copies"))
    peaked = with_peak_before(spans, KEY, "start_s", "end_s", "peak")
    before = F.greatest(F.lit(0.0), F.col("peak"))
    first = F.greatest(F.lit(0.0), F.least(before, F.col("end_s")) - F.col("start_s"))
    again = (F.col("copies") - 1) * F.greatest(F.lit(0.0), F.col("end_s") - F.col("start_s"))
    return peaked.groupBy(KEY).agg(round_exact(steady_sum(first + again), 3).alias("overlap_seconds"))


def _labels(prefix: str, names: dict) -> Column:
    return flags(*[(F.col(f"{prefix}_{name}"), name) for name in names])


def topic_tags(segments: DataFrame) -> DataFrame:
    """Topics whose terms occur anywhere in the joined words of a recording."""
    return spoken_metrics(segments).select(KEY, _labels("topic", TOPIC_TERMS).alias("topics"))


def sensitive_signals(segments: DataFrame) -> DataFrame:
    return spoken_metrics(segments).select(KEY, _labels("signal", SENSITIVE_TERMS).alias("sensitive_review_signals"))


def maori_marker_count(segments: DataFrame) -> DataFrame:
    spoken = segments.select(KEY, word_text(F.col("text")).alias("norm"))
    return spoken.groupBy(KEY).agg(F.sum(_marker_count(F.col("norm"))).alias("maori_marker_count"))


def section_hints(segments: DataFrame) -> DataFrame:
    """One row per segment and section kind whose phrases occur in it."""
    lower = F.lower(F.col("text"))
    kinds = flags(*[(any_term(lower, terms), kind) for kind, terms in SECTION_TERMS.items()])
    return segments.select(
        KEY,
        "segment",
        F.posexplode(kinds).alias("kind_no", "type"),
        F.col("start_s").alias("start"),
        stripped(F.col("text")).alias("text"),
    )


def chapters(segments: DataFrame) -> DataFrame:
    """Chapter starts: the first spoken segment and every one after a long pause, numbered from 0."""
    return chapters_with_text(segments, CHAPTER_TITLE_CHARS).withColumnRenamed("text", "title")


def chapters_with_text(segments: DataFrame, chars: int) -> DataFrame:
    """Chapter starts with the first ``chars`` characters of their opening segment."""
    opening = F.substring(stripped(F.col("text")), 1, chars).alias("text")
    rows = _spoken(segments).select(KEY, "segment", "start_s", "end_s", opening)
    found = with_previous(rows, KEY, "segment", {"ended": F.col("end_s")}).filter(_opens_chapter()).select(
        KEY,
        "segment",
        F.col("start_s").alias("start"),
        "text",
        F.when(F.col("prev").isNull(), "recording_start").otherwise("speech_after_pause").alias("basis"),
    )
    return with_position(found, KEY, "segment", "chapter", long_keys(segments, KEY, "segment"))


def disordered_recordings(segments: DataFrame) -> DataFrame:
    """Recordings in which a spoken segment does not start after the one listed before it."""
    rows = _spoken(segments).select(KEY, "segment", "start_s")
    listed = with_previous(rows, KEY, "segment", {"started": F.col("start_s")})
    return listed.filter(F.col("start_s") <= F.col("prev.started")).select(KEY).distinct()


def _quality_flags() -> Column:
    return flags(
        (F.col("coverage") < 0.1, "possible_music_or_non_speech"),
        (F.col("confidence") < 0.65, "low_word_confidence"),
        (F.col("adjacent_repeated_segments") >= 3, "repetition_detected"),
        (F.col("chapter_count") == 0, "no_speech_segments"),
        (F.col("maori_marker_count") > 0, "maori_language_or_names_review_recommended"),
        (F.col("clipped_sample_ratio") > 0.001, "clipping_detected"),
        (F.col("near_silence_ratio") > 0.9, "mostly_near_silence"),
    )


def analysis_report(
    segments: DataFrame, durations: DataFrame, diarization: DataFrame, audio: DataFrame | None = None
) -> DataFrame:
    """One row per recording with all scalar and label fields of the analysis document.

    Section hints and chapters stay child tables (:func:`section_hints`, :func:`chapters`), as their
    number per recording has no bound. ``audio`` adds the sample flags.
    """
    per_recording = durations.join(spoken_metrics(segments), KEY, "left")
    for table in (speaker_count(diarization), overlap_seconds(diarization)):
        per_recording = per_recording.join(table, KEY, "left")
    if audio is None:
        nothing = F.lit(None).cast("double")
        per_recording = per_recording.withColumns({"clipped_sample_ratio": nothing, "near_silence_ratio": nothing})
    else:
        per_recording = per_recording.join(audio.select(KEY, "clipped_sample_ratio", "near_silence_ratio"), KEY, "left")
    counts = ("adjacent_repeated_segments", "chapter_count", "maori_marker_count", "speaker_count")
    filled = per_recording.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in counts})
    return filled.withColumn("coverage", _coverage()).withColumn("confidence", _confidence()).select(
        KEY,
        round_exact(F.col("coverage"), 6).alias("speech_coverage"),
        round_exact(F.col("confidence"), 6).alias("average_word_confidence"),
        "adjacent_repeated_segments",
        "speaker_count",
        F.coalesce("overlap_seconds", F.lit(0.0)).alias("overlap_seconds"),
        _labels("topic", TOPIC_TERMS).alias("topics"),
        "chapter_count",
        _quality_flags().alias("quality_flags"),
        "maori_marker_count",
        _labels("signal", SENSITIVE_TERMS).alias("sensitive_review_signals"),
        F.lit(list(ANALYSIS_LIMITATIONS)).alias("limitations"),
    )


def quality_flags(
    segments: DataFrame, durations: DataFrame, diarization: DataFrame, audio: DataFrame | None = None
) -> DataFrame:
    return analysis_report(segments, durations, diarization, audio).select(KEY, "quality_flags")
