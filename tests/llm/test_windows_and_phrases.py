"""Repeated word windows and collocated phrases against plain definitions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stackroom.llm import phrases, window_dedup
from stackroom.llm.queries import op11_phrase_collocations, op13_window_dedup
from stackroom.runtime import materialised, materialised_by

SCHEMA = "doc_id long, text string, lang string, n long, part long, window string, id long"


def table(spark, rows):
    return materialised(spark.createDataFrame([(i, t, lang, 1, 2, "x", 3) for i, t, lang in rows], SCHEMA))


def plain_windows(rows, size=13):
    """Words, removed words and digest per row."""
    split = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    first = {}
    for i, words in split:
        for at in range(len(words) - size + 1 if i is not None else 0):
            key = tuple(words[at : at + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - size + 1 if i is not None else 0):
            if first[tuple(words[at : at + size])] < i:
                gone.update(range(at, at + size))
        kept = " ".join(w for at, w in enumerate(words) if at not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def window_rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in df.collect()), key=repr)


def texts(seed):
    draw = random.Random(seed)
    words = ["a", "b", "é", "c d", "\x1f", "x" * 50]
    rows = [(n, " ".join(draw.choices(words, k=draw.choice([3, 12, 13, 14, 40, 90])))) for n in range(40)]
    passage = " ".join(f"p{n}" for n in range(60))
    rows += [(n, f"{draw.random()} {passage[: draw.randint(50, 240)]}\n\t{draw.random()}") for n in range(40, 80)]
    rows += [(3, passage), (None, passage), (None, passage), (80, None), (81, ""), (82, " \n "), (83, passage), (83, passage + " end"), (-5, passage.replace(" ", "\x0b \t"))]
    return rows + [(84, " ".join(f"w{n % 50}" for n in range(30_000)))]


@pytest.mark.parametrize("part_words", [window_dedup.PART_WORDS, 60])
def test_windows_against_plain_version(spark, part_words):
    rows = texts(part_words)
    cleaned = window_dedup.without_repeats(table(spark, [(i, t, None) for i, t in rows]), part_words=part_words)
    assert window_rows(window_dedup.digest(cleaned)) == plain_windows(rows)
    for row in cleaned.collect():
        assert sum(s["end"] - s["start"] for s in row["removed"]) == row["n_removed"]
        assert len(row["text"].encode().split()) == row["n_words"] - row["n_removed"]


def test_windows_of_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert window_rows(op13_window_dedup(spark, sf)) == plain_windows(rows)


def test_windows_of_empty_table(spark):
    assert window_dedup.without_repeats(table(spark, [])).count() == 0


def test_sketch_never_underestimates():
    """Every hash that is met twice is estimated so, however few cells there are; slices add up over parts."""
    cells = window_dedup.Cells(600)
    draw = np.random.default_rng(3)
    parts = [draw.integers(0, 1 << 40, 300, np.uint64) for _ in range(4)]
    true = Counter(np.concatenate(parts).tolist() + parts[0][:50].tolist())
    parts[3] = np.concatenate([parts[3], parts[0][:50]])
    total = np.zeros(window_dedup.ROWS << cells.bits, np.int64)
    for part in parts:
        found, counts, _ = cells.of(part)
        back, again = window_dedup.unpacked_cells(window_dedup.packed_cells(found, counts), len(found))
        assert (back == found).all() and (again == np.minimum(counts, 2)).all()
        total[found] += again
    for part in parts:
        found, _, place = cells.of(part)
        least = total[found][place].min(axis=0)
        assert all(e >= min(2, true[h]) for e, h in zip(least.tolist(), part.tolist()))


def plain_phrases(rows, least, reported):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    counts[lang][tuple(words[at : at + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and p[i:j] in candidates and 100 * a >= 80 * candidates[p[i:j]]}
        scored = []
        for p, a in candidates.items():
            if p in dropped:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:reported], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def spoken(seed):
    draw = random.Random(seed)
    words = ["The", "the", "of", "a-b", "Éa", "éa", "x", "y", " ", "\x00", "zz"]
    rows = []
    for n in range(150):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\r\n", ";"]) for _ in range(draw.choice([0, 1, 30, 80])))
        rows.append((text + "New  york Stock exchange " * draw.choice([0, 0, 1, 3]), draw.choice(["en", "fr", None, "und"])))
    return [*rows, (None, "en"), (None, None), (" x y " * 20_000, "de")]


@pytest.mark.parametrize("part_bytes", [phrases.PART_BYTES, 400])
def test_phrases_against_plain_version(spark, part_bytes):
    rows = spoken(part_bytes)
    docs = table(spark, [(n, t, lang) for n, (t, lang) in enumerate(rows)])
    for least, reported in ((30, 2000), (4, 25)):
        found = phrases.phrases(docs, least=least, reported=reported, part_bytes=part_bytes)
        assert phrase_rows(found) == plain_phrases(rows, least, reported)


def test_phrases_of_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()]
    assert phrase_rows(op11_phrase_collocations(spark, sf)) == plain_phrases(rows, 30, 2000)


def test_phrases_of_empty_table(spark):
    assert phrases.phrases(table(spark, [])).count() == 0


def test_exact_products(spark):
    """Counts whose product with the scale passes 64 bits."""
    n = 4_000_000_000_000_000_000
    one = spark.range(1).select(
        F.lit(0).alias("id"), F.lit("en").alias("lang"), F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit(n).cast("long").alias("n"),
        F.lit("p q").alias("phrase"), F.array(F.lit(n).cast("long")).alias("heads"), F.array(F.lit(n + 1).cast("long")).alias("tails"),
    )
    assert phrases._scored(one).first()["score"] == 2_000_000 * n // (2 * n + 1)


def test_tiles_count_like_a_list():
    draw = np.random.default_rng(1)
    a, b = (np.minimum(draw.zipf(1.3, 200_000), 5_000) for _ in range(2))
    x, y, n = phrases.tile_counts(a, b, 32)
    assert (np.bincount(a // 32 * 200 + b // 32) >= 64).any()
    assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == Counter(zip(a.tolist(), b.tolist()))
    assert len(x) == len(set(zip(x.tolist(), y.tolist())))


def test_parts_are_dealt_once(spark):
    """Parts meet their answers where they lie: only the answers are shuffled, and the table's name is gone."""
    parts = materialised_by(spark.range(40).selectExpr("id AS part", "CAST(id AS STRING) AS texts"), "part")
    answers = spark.range(80).selectExpr("id % 40 AS part", "id AS n")
    met = window_dedup._with(parts, answers, lambda a, b: pa.table({"part": a.column("part"), "n": [b.num_rows] * a.num_rows}), "part long, n long")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
    assert sorted(tuple(r) for r in met.collect()) == [(k, 2) for k in range(40)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stackroom_")]
