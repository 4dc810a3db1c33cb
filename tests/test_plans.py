import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stackroom.plans.bands import similar_codes
from stackroom.plans.blocks import long_keys, with_next, with_peak_before, with_position, with_previous
from stackroom.plans.intervals import first_in_spans, least_in_spans, points_near
from stackroom.plans.order import latest_per_key, ranked_per_key, row_index, top_per_key
from stackroom.plans.skew import join_per_key


def test_row_index_equals_row_number(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 5 + [f"k{i}" for i in range(50)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v string, i int").repartition(7)
    got = {(r["v"], r["i"]): r["row_index"] for r in row_index(df, ["v", "i"]).collect()}
    assert got == {row: n for n, row in enumerate(sorted(rows))}


def sequence_rows(seed):
    """Gapped positions; one key holds a third of the rows."""
    rng = random.Random(seed)
    rows = [("hot", p, rng.randrange(100)) for p in range(60) if rng.random() < 0.7]
    rows += [(f"k{k}", p, rng.randrange(100)) for k in range(8) for p in range(15) if rng.random() < 0.6]
    return rows


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 3, 7, 1000]))
def test_block_windows_equal_plain_windows(spark, seed, block):
    df = spark.createDataFrame(sequence_rows(seed), "k string, p bigint, v int")
    w = Window.partitionBy("k").orderBy("p")
    plain = df.select(
        "k", "p", F.lag("v").over(w).alias("a"), F.lead("v").over(w).alias("b"), (F.row_number().over(w) - 1).alias("n")
    ).collect()
    before = with_previous(df, "k", "p", {"v": F.col("v")}, block_rows=block).select("k", "p", F.col("prev.v").alias("a"))
    after = with_next(df, "k", "p", {"v": F.col("v")}, block_rows=block).select("k", "p", F.col("next.v").alias("b"))
    place = with_position(df, "k", "p", "n", long_keys(df, "k", "p", block), block).select("k", "p", "n")
    joined = before.join(after, ["k", "p"]).join(place, ["k", "p"]).select("k", "p", "a", "b", "n")
    assert sorted(map(tuple, joined.collect())) and sorted(map(repr, map(tuple, joined.collect()))) == sorted(map(repr, map(tuple, plain)))


def test_peak_before(spark):
    rng = random.Random(5)
    rows = sorted({(rng.choice("ab"), float(rng.randrange(50)), float(rng.randrange(80))) for _ in range(200)})
    df = spark.createDataFrame(rows, "k string, s double, e double")
    w = Window.partitionBy("k").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumn("m", F.max("e").over(w))
    got = with_peak_before(df, "k", "s", "e", "m", cell_seconds=5.0).select(plain.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0.0, 0.5, 2.0, 100.0]))
def test_points_near_equals_nested_loop(spark, seed, tolerance):
    rng = random.Random(seed)
    points = [(rng.choice("ab"), rng.randrange(-40, 200) / 4) for _ in range(60)]
    targets = [(rng.choice("ab"), rng.randrange(-40, 200) / 4) for _ in range(20)]
    got = points_near(
        spark.createDataFrame(points, "k string, t double"), spark.createDataFrame(targets, "k string, t double"), "k", "t", tolerance
    )
    want = {(k, t) for k, t in points if any(k == q and abs(t - u) <= tolerance for q, u in targets)}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_first_in_spans_with_disordered_starts(spark):
    rng = random.Random(6)
    for _ in range(3):
        starts = [(k, c, float(rng.randrange(1000))) for k in "ab" for c in range(6)]
        spans = [(k, c, s, next((t for q, d, t in starts if q == k and d == c + 1), None)) for k, c, s in starts]
        points = [(rng.choice("ab"), float(rng.randrange(1200)), i) for i in range(80)]
        got = first_in_spans(
            spark.createDataFrame(spans, "k string, c int, s double, e double"),
            spark.createDataFrame(points, "k string, t double, i bigint"),
            "k", "c", "s", "e", "t", "i", cell=50.0,
        )
        want = {}
        for k, c, s, e in spans:
            inside = [i for q, t, i in points if q == k and s <= t and (e is None or t < e)]
            if inside:
                want[(k, c)] = min(inside)
        assert {(r["k"], r["c"]): r["i"] for r in got.collect()} == want


def mutated_codes(seed, base_count, copies):
    rng = random.Random(seed)
    codes = []
    for _ in range(base_count):
        base = [rng.choice("0123456789abcdef") for _ in range(64)]
        for _ in range(copies):
            code = list(base)
            for _ in range(rng.randrange(0, 8)):
                code[rng.randrange(64)] = rng.choice("0123456789abcdef")
            codes.append("".join(code))
    return codes


def test_similar_codes_equals_all_pairs(spark):
    codes = mutated_codes(7, 12, 12) + ["short", ""]
    codes += [c[:63] for c in codes[:20] if c] + [codes[0][:62] + "zz", codes[0] + "q"]
    want = set()
    full = sorted({c for c in codes if c})
    for i, a in enumerate(full):
        for b in full[i + 1 :]:
            share = round(sum(x == y for x, y in zip(a, b)) / max(len(a), len(b)), 6)
            if share >= 0.92:
                want.add((a, b, share))
    assert want
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    for crowd in (1000, 2):
        assert {tuple(r) for r in similar_codes(df, "c", 64, 0.92, band_rows=crowd).collect()} == want


def test_similar_codes_in_crowded_bands(spark):
    """Many codes that share two bands, of which only a few are similar."""
    rows = spark.range(6_000).selectExpr("id", "concat(repeat('a', 22), substr(sha2(string(id), 256), 1, 42)) AS c")
    twins = rows.filter("id % 1500 = 0").selectExpr("id", "concat(substr(c, 1, 63), 'g') AS c")
    found = similar_codes(rows.unionByName(twins), "c", 64, 0.92, band_rows=200)
    assert found.count() == 4


def test_similar_codes_needs_a_common_band(spark):
    df = spark.createDataFrame([("ab",)], "c string")
    assert similar_codes(df, "c", 2, 1.0).collect() == []
    with pytest.raises(ValueError):
        similar_codes(df, "c", 2, 0.0)


def test_join_per_key_keeps_all_rows(spark):
    facts = [("hot", i) for i in range(500)] + [(f"k{i % 700}", i) for i in range(1000)] + [(None, -1)]
    df = spark.createDataFrame(facts, "k string, i int")
    per_key = df.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("top")).filter("k != 'k3'")
    got = join_per_key(df, per_key, "k", "n")
    plain = df.join(per_key.drop("n"), "k", "left")
    assert sorted(map(repr, got.select("k", "i", "top").collect())) == sorted(map(repr, plain.select("k", "i", "top").collect()))


def test_deep_ranks_equal_group_limits(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", "x", "y"]), rng.randrange(50), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, c int, i int")
    order = [F.desc("c"), F.col("i")]
    near = ranked_per_key(df, "k", order, "n", 30)
    deep = ranked_per_key(df, "k", order, "n", 30, group_limit=0).select(near.columns)
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, deep.collect()))


def test_first_and_latest_rows(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, p int, v string")
    assert sorted(map(tuple, top_per_key(df, ["k"], ["p"]).collect())) == [("a", 1, "y"), ("b", 3, "z")]
    assert sorted(map(tuple, latest_per_key(df, "k", "p").collect())) == [("a", 2, "x"), ("b", 3, "z")]


def test_least_in_overlapping_spans(spark):
    """Nested, empty and open spans, points on their edges, and one key with most of the points."""
    rng = random.Random(8)
    for most in (3, 40, 700):
        spans = [(rng.choice(["a", "b", None]), c % 9, float(rng.randrange(60)), rng.choice([None, *map(float, range(0, 70, 3))])) for c in range(60)]
        points = [(rng.choice(["a"] * 8 + ["b", None, "c"]), rng.choice([None, float(rng.randrange(65))]), rng.randrange(1000)) for _ in range(most)]
        got = least_in_spans(
            spark.createDataFrame(spans, "k string, c int, s double, e double"),
            spark.createDataFrame(points, "k string, t double, i bigint"),
            "k", "c", "s", "e", "t", "i",
        )
        want = {}
        for k, c, s, e in spans:
            inside = [i for q, t, i in points if q == k and t is not None and s <= t and (e is None or t < e)]
            if inside:
                want[k, c, s] = min([want.get((k, c, s), 10**9), *inside])
        assert {(r["k"], r["c"], r["s"]): r["i"] for r in got.collect()} == want


def test_running_peak_of_one_crowded_cell(spark):
    """All turns of a recording start within a second: they are dealt to blocks of equal row counts."""
    rng = random.Random(4)
    rows = list({("hot", rng.randrange(1000) / 1000, round(rng.random() * 600, 3)) for _ in range(20_000)})
    rows += [(k, 0.0, float(n)) for k in ("b", "c") for n in range(3)]
    df = spark.createDataFrame(rows, "k string, s double, e double")
    got = with_peak_before(df, "k", "s", "e", "m", block_rows=500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_cell" in plan
    want, peak, last = {}, None, None
    for k, s, e in sorted(rows):
        peak = None if k != last else peak
        want[k, s, e] = peak
        peak, last = e if peak is None else max(peak, e), k
    assert {(r["k"], r["s"], r["e"]): r["m"] for r in got.collect()} == want
