"""Gram lists, facet roll-ups, pivots and long pages against plain versions."""

import random
import time
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackroom.functions.urls import unescaped
from stackroom.operators import enrichment, facets, media, vectors
from stackroom.operators.entry_index import EntryIndex, grams_of
from stackroom.operators.facet_rollup import FacetRollup
from workload.views import records, segments

ENTRIES = "recording_id string, segment long, start_s double, end_s double, text string"
QUERIES = ["kia ora koutou", "Welingtn", "ab", "a", "", "xyz 123", "1 2 3 4", "the quick brown fox jumps", "éé", "aaa bbb"]


@pytest.fixture(scope="module")
def entries(spark):
    draw = random.Random(9)
    words = ["kia", "ora", "koutou", "katoa", "wellington", "1", "2", "3", "ab", "aaa", "bbb", "quick", "brown", "fox", "É", "😀", "x"]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 9))) for _ in range(300)]
    texts += ["Kia  ORA koutou", "kia orra kotou", "123 45 6", "", "aaa bbbb", "the quick brown fox jumped", "😀éé"]
    rows = [(f"r{i % 7}", i, float(i % 50), float(i), t) for i, t in enumerate(texts)]
    return enrichment.search_entries(spark.createDataFrame(rows, ENTRIES)).cache()


def plain_matches(rows, query, sounds, threshold=0.55):
    wanted = " ".join(query.casefold().split())
    out = []
    for r in rows:
        exact = bool(wanted) and wanted in r["normalized"]
        sound = bool(set(sounds) & set(r["phonetic_terms"]))
        ratio = SequenceMatcher(None, wanted, r["normalized"]).ratio() if wanted else 0.0
        if exact or sound or ratio >= threshold:
            out.append((r["recording_id"], r["segment"], "exact" if exact else "phonetic" if sound else "fuzzy", 1.0 if exact else 0.9 if sound else round(ratio, 6)))
    return sorted(out)


def rows_of(df):
    return sorted((r["recording_id"], r["segment"], r["match"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def index(spark, entries, tmp_path_factory):
    index = EntryIndex(spark, str(tmp_path_factory.mktemp("entries")))
    index.add(entries.filter("segment < 100"))
    index.add(entries.filter("segment >= 100"))
    return index


@pytest.mark.parametrize("query", QUERIES)
def test_index_equals_brute_force(spark, entries, index, query):
    sounds = spark.range(1).select(enrichment.phonetic_terms(F.lit(query))).first()[0]
    rows = entries.collect()
    for threshold in (0.55, 0.8):
        want = plain_matches(rows, query, sounds, threshold)
        assert rows_of(index.matches(query, threshold)) == want
        assert rows_of(enrichment.fuzzy_matches(entries, query, threshold)) == want
    best = [tuple(r) for r in index.search(query, 5).collect()]
    assert best == [tuple(r) for r in enrichment.fuzzy_search(entries, query, 5).collect()]


def test_merged_index(spark, entries, tmp_path):
    index = EntryIndex(spark, str(tmp_path / "i"))
    assert index.matches("kia ora").count() == 0
    for part in range(3):
        index.add(entries.filter(F.col("segment") % 3 == part))
    before = rows_of(index.matches("kia ora koutou"))
    index.compact()
    assert rows_of(index.matches("kia ora koutou")) == before and before
    numbers = [r["entry"] for r in index.tables.rows("entries").select("entry").collect()]
    assert len(numbers) == len(set(numbers)) == entries.count()


def test_common_subsequence(spark):
    """The bits give the longest common subsequence; of long queries at least that."""
    draw = random.Random(5)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            diagonal = 0
            for j, y in enumerate(b, 1):
                diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    texts = ["".join(draw.choices("ab cé😀", k=draw.randint(0, 90))) for _ in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for wanted in ("a", "ab c", "😀é b" * 14, "abc" * 45):
        found = rows.select("t", enrichment.common_characters(wanted, F.col("t")).alias("n")).collect()
        for r in found:
            assert r["n"] == longest(wanted, r["t"]) if len(wanted) <= 60 else r["n"] >= longest(wanted, r["t"])


def test_bounds_hold():
    """Matched characters of random pairs never pass what the shared grams allow."""
    draw = random.Random(3)
    for _ in range(3000):
        a, b = ("".join(draw.choices("aab c", k=draw.randint(0, 14))) for _ in range(2))
        matched = sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())
        for size in (1, 2):
            shared = sum((grams_of(a, size) & grams_of(b, size)).values())
            assert (2 * size - 1) * matched <= shared + (size - 1) * (len(a) + len(b) + 1)


def test_few_entries_reach_the_ratio(spark):
    """Under 5 % of the given texts have neither an exact nor a sounding match and pass the bounds; they hold all other matches."""
    rows = enrichment.search_entries(segments(spark, "/root/testdata/sf0.01"))
    total = rows.count()
    for query in ("Kia aro koutuu", "parliament", "the hon thand er"):
        plan = enrichment.fuzzy_matches(rows, query)._jdf.queryExecution().optimizedPlan().toString()
        assert "ArrowEvalPython" in plan
        wanted = " ".join(query.casefold().split())
        n = F.col("normalized")
        total_chars = 0.55 * (F.length(n) + len(wanted))
        passed = rows.filter((2.0 * enrichment.common_characters(wanted, n) >= total_chars) & (enrichment.ratio_bound(F.lit(wanted), n) >= 0.55))
        closed = enrichment.fuzzy_matches(rows, query).filter("match != 'fuzzy'").select("recording_id", "segment")
        assert passed.join(closed, ["recording_id", "segment"], "left_anti").count() < 0.05 * total, query
    found = rows_of(enrichment.fuzzy_matches(rows, "Kia aro koutuu"))
    sounds = spark.range(1).select(enrichment.phonetic_terms(F.lit("Kia aro koutuu"))).first()[0]
    assert found == plain_matches(rows.collect(), "Kia aro koutuu", sounds)


def test_rollup_equals_full_count(spark, sf, tmp_path):
    rows = records(spark, sf).select("pos", "category", "usage", "year")
    fields = ["category", "usage", "year"]
    rollup = FacetRollup(spark, str(tmp_path / "f"), fields)
    assert rollup.counts().count() == 0
    draw = random.Random(1)
    current: dict[int, int] = {}
    for step in range(11):
        chosen = draw.sample(range(200), 40)
        part = rows.filter(F.col("pos").isin(chosen))
        if step % 4 == 3:
            rollup.remove(part)
            for n in chosen:
                current.pop(n, None)
        else:
            changed = part.withColumn("usage", F.when(F.col("pos") % 3 != 0, F.lit(f"step {step}"))).withColumn("year", F.array(F.lit("1900"), F.lit(str(1900 + step)), F.lit("1900")))
            rollup.add(changed.unionByName(changed))
            current |= dict.fromkeys(chosen, step)
    rollup.compact()
    state = spark.createDataFrame(list(current.items()), "pos long, step int")
    now = rows.join(state, "pos").withColumn("usage", F.when(F.col("pos") % 3 != 0, F.concat(F.lit("step "), "step"))).withColumn("year", F.array(F.lit("1900"), (1900 + F.col("step")).cast("string")))
    want = sorted(map(tuple, facets.facet_counts(now, fields).collect()))
    assert sorted(map(tuple, rollup.counts().select("field", "term", "count").collect())) == want


@pytest.mark.parametrize("limit", [1, 5, 60])
def test_pivots_find_the_exact_best(spark, monkeypatch, limit):
    """Several lengths, crowded directions, many clusters and queries in several blocks."""
    monkeypatch.setattr(vectors, "PIVOTS", 12)
    monkeypatch.setattr(vectors, "SLICE_ROWS", 50)
    monkeypatch.setattr(vectors, "QUERY_BYTES", 256)
    rng = np.random.default_rng(limit)
    centres = rng.normal(size=(9, 6))
    rows = [(f"v{i:04d}", [float(x) for x in centres[i % 9] + 0.2 * rng.normal(size=6)]) for i in range(600)]
    rows += [(f"hot{i}", [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(200)] + [(f"w{i}", [float(x) for x in rng.normal(size=3)]) for i in range(40)]
    rows += [("zero", [0.0] * 6), ("none", None), ("empty", []), ("nan", [float("nan")] * 6), ("a", [1.0])]
    table = spark.createDataFrame(rows, "record_id string, embedding array<float>")
    wanted = [(f"q{i}", [float(x) for x in rng.normal(size=6)]) for i in range(12)] + [("hot", [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), ("w", [1.0, 2.0, 3.0]), ("z", [0.0] * 6), ("n", None), ("lone", [5.0, 1.0])]
    queries = spark.createDataFrame(wanted, "query_id string, embedding array<double>")
    found: dict[str, list] = {}
    for r in vectors.vector_top_k_batch(table, queries, limit).collect():
        found.setdefault(r["query_id"], []).append((-r["score"], r["record_id"]))
    for name, q in wanted:
        scores = []
        for r, v in rows:
            fits = q is not None and v is not None and len(v) == len(q) and len(q) > 0
            x, y = (np.array(np.float32(v), float), np.array(q)) if fits else (None, None)
            norm = np.linalg.norm(x) * np.linalg.norm(y) if fits else 0
            scores.append((-(round(float(x @ y) / norm, 9) if norm > 0 else 0.0), r))
        want = sorted(scores)[:limit]
        got = sorted(found[name])
        assert np.allclose([s for s, _ in got], [s for s, _ in want], atol=2e-9)
        assert [r for s, r in got if s < want[-1][0] - 1e-8] == [r for s, r in want if s < want[-1][0] - 1e-8]
        assert Counter(len(got) for _ in [0]) == Counter([min(limit, len(rows))])


def test_long_pages_take_linear_time(spark):
    """10,000 ids and 100,000 character references on one page."""
    ids = ", ".join(f'{{"id": {n}, "audio": "https://x.org/{n}.mp3"}}' for n in range(1, 10_001))
    references = "&amp;&eacute;&#39;&unknown;" * 25_000
    entry = media.AUDIO_ENTRY
    html = f'<p>{references}</p>{ids}{{"id": 77777, "{entry}": "https:\\/\\/x.org\\/own.mp3"}}{{"id": 8, "{entry}": "https://x.org/late.mp3"}}'
    page = spark.createDataFrame([("https://x.org/audio/77777", html), ("https://x.org/audio/7777", html)], "url string, html string")
    started = time.monotonic()
    got = [r[0] for r in page.select(media.matching_audio_url(F.col("url"), F.col("html"))).collect()]
    assert got == ["https://x.org/own.mp3", "https://x.org/own.mp3"]
    text = page.select(unescaped(F.col("html"))).first()[0]
    assert text.startswith("<p>&é'&unknown;&é'") and text.count("é") == 25_000
    assert time.monotonic() - started < 60
