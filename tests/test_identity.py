import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stackroom.operators import dedup


def test_titles_keep_first_and_drop_empty(spark):
    rows = [(1, "1", "Kauri Tree"), (2, "2", " kauri tree\t"), (3, "3", "Harbour"), (4, "4", " \t "), (5, "5", None)]
    df = spark.createDataFrame(rows, "pos bigint, id string, title string")
    assert sorted(r["id"] for r in dedup.dedup_by_title(df).collect()) == ["1", "3"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("abAB ", max_size=4), max_size=30))
def test_title_count_law(spark, titles):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "pos bigint, title string")
    want = {}
    for i, t in enumerate(titles):
        if t.strip():
            want.setdefault(t.lower().strip(), i)
    assert sorted(r["pos"] for r in dedup.dedup_by_title(df).collect()) == sorted(want.values())


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**6))
def test_exact_duplicates_equal_the_log_scan(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"r{rng.randrange(12)}", rng.choice(["hot", "hot", f"h{rng.randrange(15)}", None])) for i in range(120)]
    df = spark.createDataFrame(rows, "pos bigint, record_id string, normalized_sha256 string")
    got = {r["pos"]: r["duplicate_of"] for r in dedup.exact_duplicates(df).collect()}
    want = {
        p: next((q for o, q, g in rows if h is not None and g == h and q != r and o < p), None) for p, r, h in rows
    }
    assert got == want


def test_similarity_candidates_equal_all_pairs(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("0123456789abcdef") for _ in range(64)) for _ in range(4)]
    rows = []
    for i in range(90):
        code = list("f" * 64 if i % 3 == 0 else rng.choice(base))
        for _ in range(0 if i % 3 == 0 else rng.randrange(0, 8)):
            code[rng.randrange(64)] = rng.choice("0123456789abcdef")
        rows.append((f"r{i}", rng.randrange(10**6) * 100 + i, "".join(code)))
    df = spark.createDataFrame(rows, "record_id string, pos bigint, fingerprint string")
    got = {r["record_id"]: (r["first_candidate"], r["score"], r["review_required"]) for r in dedup.similarity_candidates(df).collect()}
    for record, pos, code in rows:
        earlier = [
            (p, r, round(sum(a == b for a, b in zip(code, c)) / 64, 6)) for r, p, c in rows if p < pos
        ]
        earlier = sorted(e for e in earlier if e[2] >= 0.92)
        want = (earlier[0][1], earlier[0][2], True) if earlier else (None, None, False)
        assert got[record] == want


def test_media_candidates_in_order(spark):
    df = spark.createDataFrame(
        [(["https://radio.example/a.mp3", "https://radio.example/a.mp3"], ["https://radio.example/story"], None), (None, ["http://x"], ["https://y"])],
        "a array<string>, b array<string>, c array<string>",
    )
    got = df.select(dedup.media_candidates(F.col("a"), F.col("b"), F.col("c")).alias("u")).collect()
    assert [r["u"] for r in got] == [["https://radio.example/a.mp3", "https://radio.example/story"], ["https://y"]]
