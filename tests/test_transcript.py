import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from stackroom.fixed_values import SENSITIVE_TERMS, TOPIC_TERMS
from stackroom.operators import enrichment, transcript
from stackroom.plans import blocks

SCHEMA = "recording_id string, segment bigint, start_s double, end_s double, text string, speaker string, words array<struct<word: string, score: double>>"


def seg(spark, *rows, recording="r"):
    full = [(recording, i, float(s), float(e), t, None, w) for i, (s, e, t, w) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def dia(spark, *rows, recording="r"):
    return spark.createDataFrame([(recording, float(s), float(e), p) for s, e, p in rows], "recording_id string, start_s double, end_s double, speaker string")


def dur(spark, seconds, recording="r"):
    return spark.createDataFrame([(recording, float(seconds))], "recording_id string, duration double")


@pytest.fixture(scope="module")
def broadcast(spark):
    return seg(
        spark,
        (0, 4, "The headlines: Parliament sits, Te Tiriti talks go on", [("headlines", 0.9)]),
        (10, 14, "Joining us on iwi land and housing", [("land", 0.8)]),
    )


def test_analysis_of_a_broadcast(spark, broadcast):
    row = transcript.analysis_report(broadcast, dur(spark, 20), dia(spark, (0, 5, "SPEAKER_00"), (4, 8, "SPEAKER_01"))).first()
    assert row["topics"] == ["parliament_and_politics", "te_tiriti_and_maori_affairs", "housing"]
    assert row["quality_flags"] == ["maori_language_or_names_review_recommended"]
    assert row["speaker_count"] == 2 and row["overlap_seconds"] == 1.0 and row["chapter_count"] == 2
    assert row["speech_coverage"] == 0.4 and row["average_word_confidence"] == 0.85
    assert row["maori_marker_count"] == 2 and len(row["limitations"]) == 4
    hints = {(r["segment"], r["type"]) for r in transcript.section_hints(broadcast).collect()}
    assert hints == {(0, "headlines"), (1, "interview")}
    chapters = transcript.chapters(broadcast).orderBy("chapter").collect()
    assert [(c["start"], c["basis"]) for c in chapters] == [(0.0, "recording_start"), (10.0, "speech_after_pause")]


def test_empty_transcript(spark):
    row = transcript.analysis_report(seg(spark), dur(spark, 60), dia(spark)).first()
    assert row["quality_flags"] == ["possible_music_or_non_speech", "no_speech_segments"]
    assert row["average_word_confidence"] is None and row["topics"] == [] and row["overlap_seconds"] == 0.0
    audio = spark.createDataFrame([("r", 0.25, 0.95)], "recording_id string, clipped_sample_ratio double, near_silence_ratio double")
    flagged = transcript.quality_flags(seg(spark), dur(spark, 0), dia(spark), audio).first()["quality_flags"]
    assert flagged[-2:] == ["clipping_detected", "mostly_near_silence"]


def test_sensitive_text(spark):
    row = transcript.sensitive_signals(seg(spark, (0, 2, "One caller spoke of family violence", []))).first()
    assert row["sensitive_review_signals"] == ["callers_or_public_contributors", "distressing_subject_matter"]


def reference_labels(texts):
    """Labels from the joined text, as one string."""
    norms = [re.sub(r"\W+", " ", t.lower()).strip() for t in texts if t.strip()]
    full = " ".join(norms)
    topics = [n for n, terms in TOPIC_TERMS.items() if any(t in full for t in terms)]
    signals = [n for n, terms in SENSITIVE_TERMS.items() if any(t in f" {full} " for t in terms)]
    repeats = sum(1 for a, b in zip(norms, norms[1:]) if b and a == b)
    return topics, signals, repeats


def random_segments(seed, recordings=40):
    rng = random.Random(seed)
    pool = ["te", "tiriti", "mp", "xmp", "foreign", "affairs", "call", "us", "school", "student", "family", "violence", "...", "caller", "xcaller", "political", "party", "x" * 30, "", " ", "child", "Te", "TIRITI", "unchild", "callers", "aaaaaaaaaa callers x", "violences", "aaaaaaaaa call", "us aaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaa family"]
    rows = []
    for r in range(recordings):
        for p in range(rng.randrange(0, 9)):
            text = " ".join(rng.choice(pool) for _ in range(rng.randrange(0, 3)))
            rows.append((f"r{r}", p, p * 10.0 + rng.random(), p * 10.0 + rng.random() * 12, text, None, []))
    return rows


@pytest.mark.parametrize("block_rows", [2, 1000])
def test_labels_across_borders_equal_the_joined_text(spark, monkeypatch, block_rows):
    for name in ("with_previous", "with_position"):
        plain = getattr(blocks, name)
        monkeypatch.setattr(transcript, name, lambda *a, _f=plain, **k: _f(*a, **{**k, "block_rows": block_rows}))
    monkeypatch.setattr(transcript, "long_keys", lambda d, k, o: blocks.long_keys(d, k, o, block_rows))
    rows = random_segments(8, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    topics = {r["recording_id"]: r["topics"] for r in transcript.topic_tags(df).collect()}
    signals = {r["recording_id"]: r["sensitive_review_signals"] for r in transcript.sensitive_signals(df).collect()}
    repeats = {r["recording_id"]: r["adjacent_repeated_segments"] for r in transcript.adjacent_repeats(df).collect()}
    seen = 0
    for recording in {r[0] for r in rows}:
        texts = [r[4] for r in rows if r[0] == recording]
        if any(t.strip() for t in texts):
            want = reference_labels(texts)
            assert (topics[recording], signals[recording], repeats[recording]) == want
            seen += len(want[0]) + len(want[1])
    assert seen > 20
    chapters = [(r["recording_id"], r["chapter"], r["segment"]) for r in transcript.chapters(df).collect()]
    want = []
    for recording in {r[0] for r in rows}:
        spoken = [r for r in rows if r[0] == recording and r[4].strip()]
        opens = [s for i, s in enumerate(spoken) if i == 0 or s[2] - spoken[i - 1][3] >= 5.0]
        want += [(recording, n, s[1]) for n, s in enumerate(opens)]
    assert sorted(chapters) == sorted(want)


def test_overlap_counts_equal_rows(spark):
    rows = [(0, 5, "a"), (0, 5, "a"), (0, 5, "b"), (4, 8, "c"), (700, 710, "a"), (3, 705, "d")]
    ordered = sorted((float(s), float(e)) for s, e, _ in rows)
    total, peak = 0.0, 0.0
    for s, e in ordered:
        total += max(0.0, min(peak, e) - s)
        peak = max(peak, e)
    assert transcript.overlap_seconds(dia(spark, *rows)).first()["overlap_seconds"] == round(total, 3)


def test_enrichment(spark):
    df = seg(spark, (0, 3, "Kia ora, says Te Pāti Māori from Wellington.", []), (8, 11, "Talofa, Pacific friends.", []))
    entries = enrichment.search_entries(df).orderBy("segment").collect()
    assert entries[0]["normalized"] == "kia ora, says te pāti māori from wellington." and "W452" in entries[0]["phonetic_terms"]
    signals = {r["segment"]: r["signals"] for r in enrichment.language_signals(df).collect()}
    assert signals == {0: ["possible_te_reo_maori_or_names"], 1: ["possible_pacific_language"]}
    names = {(r["text"], r["start"]) for r in enrichment.entity_candidates(df).collect()}
    assert names == {("Kia", 0.0), ("Te Pāti Māori", 0.0), ("Wellington", 0.0), ("Talofa", 8.0), ("Pacific", 8.0)}
    summaries = enrichment.chapter_summaries(df).orderBy("chapter").collect()
    assert [(s["cited_segments"], s["start"]) for s in summaries] == [([0], 0.0), ([1], 8.0)]
    report = enrichment.enrichment_report(df).first()
    assert (report["search_entries"], report["entity_candidates"], report["chapter_summaries"]) == (2, 5, 2)


@pytest.mark.parametrize("shipped", [0, 100])
def test_summaries_of_disordered_recordings(spark, monkeypatch, shipped):
    monkeypatch.setattr(enrichment, "SHIPPED_KEYS", shipped)
    rng = random.Random(12)
    rows = []
    for r in range(30):
        starts = [float(rng.randrange(0, 300, 10)) for _ in range(rng.randrange(1, 8))]
        starts = sorted(starts) if r % 3 == 0 else starts
        rows += [(f"r{r}", i, s, s + rng.randrange(1, 12), rng.choice(["a b", "x" * 400, " ", "ok"]), None, []) for i, s in enumerate(starts)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = []
    for recording in {r[0] for r in rows}:
        spoken = [r for r in rows if r[0] == recording and r[4].strip()]
        opens = [s for i, s in enumerate(spoken) if i == 0 or s[2] - spoken[i - 1][3] >= 5.0]
        for n, c in enumerate(opens):
            end = opens[n + 1][2] if n + 1 < len(opens) else float("inf")
            cited = [s for s in spoken if c[2] <= s[2] < end]
            if cited:
                want.append((recording, n, c[2], cited[0][4].strip()[:280], cited[0][1]))
    got = [(r["recording_id"], r["chapter"], r["start"], r["text"], r["cited_segments"][0]) for r in enrichment.chapter_summaries(df).collect()]
    assert sorted(got) == sorted(want)


def test_language_words_are_whole(spark):
    df = seg(spark, (0, 1, "te'x latte", []), (1, 2, "(Te) x", []), (2, 3, "aTE whānau2", []), (3, 4, "NGĀ!", []))
    assert sorted(r["segment"] for r in enrichment.language_signals(df).collect()) == [1, 3]


def test_corrections_apply_in_order(spark):
    df = seg(spark, (4, 8, "Maori hapu", []), (9, 10, "Hapu and whanaungatanga", []), (11, 12, "nothing", []))
    rows = {r["segment"]: r for r in enrichment.corrections(df).collect()}
    assert rows[0]["corrected"] == "Māori hapū" and rows[0]["original"] == "Maori hapu" and rows[0]["start"] == 4.0
    assert rows[0]["confidence"] == "review_required"
    # The second spelling of a pair finds nothing left to replace.
    assert [c["source"] for c in rows[0]["corrections"]] == ["Maori", "hapu"]
    assert rows[1]["corrected"] == "hapū and whanaungatanga" and set(rows) == {0, 1}
    custom = enrichment.corrections(df, {"nothing": r"a $1 \d"}, "v").collect()
    assert [c["corrected"] for c in custom] == [r"a $1 \d"]


def brute_search(query, entries, limit):
    wanted = re.sub(r"\s+", " ", query.casefold()).strip()
    keys = set(entries[0]["query_keys"]) if entries else set()
    found = []
    for e in entries:
        exact = bool(wanted) and wanted in e["normalized"]
        sound = bool(keys & set(e["phonetic_terms"]))
        ratio = SequenceMatcher(None, wanted, e["normalized"]).ratio() if wanted else 0.0
        if exact or sound or ratio >= 0.55:
            found.append((-(1.0 if exact else 0.9 if sound else round(ratio, 6)), e["start"], e["segment"]))
    return sorted(found)[:limit]


@pytest.mark.parametrize("query", ["Parliament", "Welingtn", "1 2 3 4", "", "kia  ORA koutou", "123 456"])
def test_fuzzy_search_equals_brute_force(spark, query):
    from stackroom.functions.text import phonetic_terms

    texts = ["Wellington Parliament", "1 2 3 5", "kia ora koutou katoa", "kia orra kotou", "123 45 6", "", "0123 4567", "entirely different words here"]
    df = seg(spark, *[(i, i + 1, t, []) for i, t in enumerate(texts)])
    entries = enrichment.search_entries(df)
    keyed = entries.withColumn("query_keys", phonetic_terms(F.lit(query))).orderBy("segment").collect()
    got = [(-r["score"], r["start"], r["segment"]) for r in enrichment.fuzzy_search(entries, query, 5).collect()]
    assert got == brute_search(query, keyed, 5)


def test_fuzzy_kinds(spark):
    entries = enrichment.search_entries(seg(spark, (0, 2, "Wellington Parliament", [])))
    assert enrichment.fuzzy_search(entries, "Parliament").first()["match"] == "exact"
    assert enrichment.fuzzy_search(entries, "Welingtn").first()["match"] == "phonetic"
