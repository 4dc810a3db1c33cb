"""Transcript enrichment and search over segment tables."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.fixed_values import (
    CORRECTIONS,
    CORRECTIONS_VERSION,
    ENRICHMENT_LIMITATIONS,
    FUZZY_LIMIT,
    FUZZY_THRESHOLD,
    MAORI_SIGNAL,
    MAORI_TERMS,
    PACIFIC_SIGNAL,
    PACIFIC_TERMS,
    PHONETIC_SCORE,
    SUMMARY_CHARS,
)
from stackroom.functions.arrays import flags
from stackroom.functions.numbers import let, round_exact
from stackroom.functions.text import (
    SPACE,
    any_term,
    caseless,
    folded,
    phonetic_terms,
    ratio_bound,
    sequence_ratio,
    stripped,
)
from stackroom.operators.transcript import chapters, chapters_with_text, disordered_recordings
from stackroom.plans.blocks import with_next
from stackroom.plans.intervals import least_in_spans
from stackroom.runtime import materialised

KEY = "recording_id"
# Recording ids that may be shipped to every task; more of them meet the segments in a shuffle.
SHIPPED_KEYS = 100_000
# Characters of a query whose order is followed by the bits of one number.
PART_CHARS = 60
WORD = r"[\p{L}\p{N}_]"
# One possessive class: a repeated group of alternatives would take a stack frame per character of a long word.
NAME = r"[A-ZĀĒĪŌŪ][\p{L}\p{N}_'-]++"
ENTITY = rf"(?U)(?<!{WORD}){NAME}(?:{SPACE}+{NAME}){{0,3}}"


def search_entries(segments: DataFrame) -> DataFrame:
    """Searchable form per segment: stripped text, folded text, sorted phonetic keys."""
    return segments.select(
        KEY,
        "segment",
        F.col("start_s").alias("start"),
        F.col("end_s").alias("end"),
        stripped(F.col("text")).alias("text"),
        folded(F.col("text")).alias("normalized"),
        phonetic_terms(F.col("text")).alias("phonetic_terms"),
    )


def language_signals(segments: DataFrame) -> DataFrame:
    """Segments with words that ask for a language review."""
    lower = F.lower("text")
    words = F.concat(F.lit(" "), F.regexp_replace(lower, r"[^\p{L}\p{N}_']+", " "), F.lit(" "))
    maori = any_term(words, [f" {term} " for term in MAORI_TERMS])
    signals = flags((maori, MAORI_SIGNAL), (any_term(lower, PACIFIC_TERMS), PACIFIC_SIGNAL))
    found = segments.select(KEY, "segment", F.col("start_s").alias("start"), signals.alias("signals"))
    return found.filter(F.size("signals") > 0)


def entity_candidates(segments: DataFrame) -> DataFrame:
    """Capitalised runs of one to four words, distinct per recording, text and start."""
    names = F.array_distinct(F.regexp_extract_all(stripped(F.col("text")), F.lit(ENTITY), F.lit(0)))
    rows = segments.select(KEY, F.explode(names).alias("text"), F.col("start_s").alias("start")).distinct()
    return rows.withColumn("status", F.lit("unresolved_candidate"))


def _summary(start: str, text: Column, segment: str) -> list[Column]:
    return [
        F.col(start).alias("start"),
        F.substring(text, 1, SUMMARY_CHARS).alias("text"),
        F.array(segment).alias("cited_segments"),
        F.lit("first_transcript_segment_v1").alias("method"),
    ]


def chapter_summaries(segments: DataFrame) -> DataFrame:
    """First segment with text, in list order, that starts inside each chapter.

    Where segments start in list order, that is the chapter's own first segment. The recordings where they
    do not are found first; only those are searched by time. The segments are read once, for a narrow table of their
    times and the openings of their texts.
    """
    # A mark behind a cut keeps a space at the end of the opening from being stripped.
    opening = let(
        stripped(F.col("text")),
        lambda t: F.when(F.length(t) > SUMMARY_CHARS, F.concat(F.substring(t, 1, SUMMARY_CHARS), F.lit("."))).otherwise(t),
    ).alias("text")
    segments = materialised(segments.select(KEY, "segment", "start_s", "end_s", opening).filter(F.col("text") != ""))
    disordered = materialised(disordered_recordings(segments))
    count = disordered.count()
    own = chapters_with_text(segments, SUMMARY_CHARS).select(
        KEY, "chapter", *_summary("start", F.col("text"), "segment")
    )
    if count == 0:
        return own
    keys = F.broadcast(disordered) if count <= SHIPPED_KEYS else disordered
    searched = _summaries_by_time(segments.join(keys, KEY, "left_semi"))
    return own.join(keys, KEY, "left_anti").unionByName(searched)


def _summaries_by_time(segments: DataFrame) -> DataFrame:
    entries = segments.select(KEY, "segment", F.col("start_s").alias("at"), "text")
    starts = materialised(chapters(segments).select(KEY, "chapter", "start"))
    spans = with_next(starts, KEY, "chapter", {"start": F.col("start")}).select(
        KEY, "chapter", "start", F.col("next.start").alias("end")
    )
    cited = least_in_spans(spans, entries, KEY, "chapter", "start", "end", "at", "segment")
    return cited.join(entries, [KEY, "segment"]).select(
        KEY, "chapter", *_summary("start", F.col("text"), "segment")
    )


def _whole_word(source: str) -> str:
    return rf"(?iu)(?<!{WORD})\Q{source}\E(?!{WORD})"


def corrections(
    segments: DataFrame, dictionary: Mapping[str, str] = CORRECTIONS, version: str = CORRECTIONS_VERSION
) -> DataFrame:
    """Spelling review rows: the dictionary applied in order, whole words, in any case; changed rows only."""
    state: Column = F.col("original")
    applied = []
    for source, target in dictionary.items():
        entry = F.struct(
            F.lit(source).alias("source"), F.lit(target).alias("target"), F.lit(version).alias("resource_version")
        )
        applied.append(F.when(state.rlike(_whole_word(source)), entry))
        state = F.regexp_replace(state, _whole_word(source), re.sub(r"([\\$])", r"\\\1", target))
    rows = segments.select(
        KEY, "segment", F.col("start_s").alias("start"), F.col("end_s").alias("end"), stripped(F.col("text")).alias("original")
    )
    if not dictionary:
        return rows.limit(0).withColumns({"corrected": F.col("original"), "corrections": F.array()})
    # A plain substring test, in folded case, leaves few rows for the patterns.
    mentioned = any_term(caseless(F.col("original")), dict.fromkeys(s.lower() for s in dictionary))
    return (
        rows.filter(mentioned)
        .withColumns({"corrected": state, "corrections": F.array_compact(F.array(*applied))})
        .filter(F.col("corrected") != F.col("original"))
        .withColumn("confidence", F.lit("review_required"))
    )


def shared_characters(wanted: str, text: Column) -> Column:
    """Characters of a text that also stand in ``wanted``, each as often as in both: as many as can be matched at most."""
    counts = Counter(wanted)
    return sum(
        (F.least(F.lit(n), F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))) for c, n in sorted(counts.items())),
        F.lit(0),
    )


def common_characters(wanted: str, text: Column) -> Column:
    """Most characters of a text that stand in ``wanted`` in the same order, or somewhat more.

    The longest common subsequence, by the bits of a whole number per part of ``wanted``: a bit is cleared where a longer
    one ends. Parts are added up, which can only be more. Matched blocks stand in order, so no more can be matched.
    """
    total = F.lit(0)
    for start in range(0, len(wanted), PART_CHARS):
        part = wanted[start : start + PART_CHARS]
        bits: dict[str, int] = {}
        for i, c in enumerate(part):
            bits[c] = bits.get(c, 0) | 1 << i
        known = F.create_map(*[x for c, mask in bits.items() for x in (F.lit(c), F.lit(mask).cast("long"))])
        full = F.lit((1 << len(part)) - 1).cast("long")

        def step(v: Column, c: Column, known: Column = known, full: Column = full) -> Column:
            own = v.bitwiseAND(F.coalesce(F.try_element_at(known, c), F.lit(0).cast("long")))
            return (v + own).bitwiseOR(v - own).bitwiseAND(full)

        total = total + len(part) - F.bit_count(F.aggregate(F.split(text, ""), full, _two(step)))
    return total


def _two(step: Callable[..., Column]) -> Callable[[Column, Column], Column]:
    """A function of two columns, whatever else the step knows."""
    return lambda v, c: step(v, c)


def fuzzy_matches(entries: DataFrame, query: str, threshold: float = FUZZY_THRESHOLD) -> DataFrame:
    """All entries that match exactly, by sound, or by sequence ratio, with kind and score.

    Entries that cannot match, by the lengths of the texts, by the characters that they share, or by how many of these stand in
    one order, are dropped first; of the others only those that neither match exactly nor by sound reach Python.
    """
    # The normal form and the sound keys of the query are worked out once.
    forms = entries.sparkSession.range(1).select(folded(F.lit(query)).alias("wanted"), phonetic_terms(F.lit(query)).alias("sounds")).first()
    wanted, usable = F.lit(forms["wanted"]), bool(forms["wanted"])
    by_sound = F.arrays_overlap("phonetic_terms", F.lit(list(forms["sounds"]))) if forms["sounds"] else F.lit(False)
    by_sound = F.coalesce(by_sound, F.lit(False))
    if not usable:
        exact, open_case = F.lit(False), F.lit(False)
    else:
        exact = F.contains("normalized", wanted)

        def alike(n: Column) -> Column:
            least = (threshold - 1e-9) * (F.length(n) + len(forms["wanted"]))
            shared = (ratio_bound(wanted, n) >= threshold) & (2.0 * shared_characters(forms["wanted"], n) >= least)
            # The order of the characters is only looked at where there are enough of them.
            return F.when(shared, 2.0 * common_characters(forms["wanted"], n) >= least).otherwise(False)

        open_case = ~exact & ~by_sound & let(F.col("normalized"), alike)
    judged = entries.withColumns({"_exact": exact, "_sound": by_sound, "_open": open_case})
    judged = judged.filter(F.col("_exact") | F.col("_sound") | F.col("_open"))
    ratio = sequence_ratio(F.when(F.col("_open"), wanted), F.when(F.col("_open"), F.col("normalized")))
    scored = judged.withColumn("_ratio", ratio)
    return (
        scored.filter(F.col("_exact") | F.col("_sound") | (F.col("_ratio") >= threshold))
        .withColumn("match", F.when(F.col("_exact"), "exact").when(F.col("_sound"), "phonetic").otherwise("fuzzy"))
        .withColumn(
            "score",
            F.when(F.col("_exact"), 1.0)
            .when(F.col("_sound"), PHONETIC_SCORE)
            .otherwise(round_exact(F.col("_ratio"), 6)),
        )
        .select(KEY, "segment", "start", "end", "text", "match", "score")
    )


def best_matches(matches: DataFrame, limit: int = FUZZY_LIMIT) -> DataFrame:
    """The best rows of :func:`fuzzy_matches` by score, then start, then list order."""
    return matches.orderBy(F.desc("score"), "start", KEY, "segment").limit(limit)


def fuzzy_search(entries: DataFrame, query: str, limit: int = FUZZY_LIMIT) -> DataFrame:
    """Best matches by score, then start, then list order."""
    return best_matches(fuzzy_matches(entries, query), limit)


def enrichment_report(segments: DataFrame) -> DataFrame:
    """One row per recording with the sizes of the enrichment tables and the fixed limitations.

    The tables themselves stay flat: they have no bound per recording.
    """
    parts = {
        "language_review_signals": language_signals(segments),
        "entity_candidates": entity_candidates(segments),
        "search_entries": segments,
        "chapter_summaries": chapter_summaries(segments),
        "orthographic_corrections": corrections(segments),
    }
    rows = [t.select(KEY, F.lit(name).alias("part")) for name, t in parts.items()]
    stacked = rows[0]
    for more in rows[1:]:
        stacked = stacked.unionByName(more)
    return stacked.groupBy(KEY).agg(
        *[F.count_if(F.col("part") == name).alias(name) for name in parts]
    ).withColumn("limitations", F.lit(list(ENRICHMENT_LIMITATIONS)))
