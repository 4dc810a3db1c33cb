import hashlib
import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stackroom.llm import minhash, suffix_array, suffix_dedup
from stackroom.llm.common import components
from stackroom.llm.queries import QUERIES


def profile(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def probability_jaccard(x, y):
    wx, wy = ({k: 1 + math.log(v) for k, v in c.items()} for c in (x, y))
    every = set(wx) | set(wy)
    return sum(1 / sum(max(wx.get(j, 0) / wx[k], wy.get(j, 0) / wy[k]) for j in every) for k in wx.keys() & wy.keys())


def test_similarity_by_definition():
    texts = ["a b c d e f g a b c d e f g h", "a b c d e f g h i j a b c d e", "a b", "a b c d e f g a b c d e f g h"]
    for s in texts:
        for t in texts:
            got = minhash.probability_jaccard(*[minhash.shingles([minhash.normal(u)], 5)[1:] for u in (s, t)])
            assert got == pytest.approx(probability_jaccard(profile(s), profile(t)), abs=1e-12)


def test_registers_estimate_similarity():
    base = [f"w{i}" for i in range(400)] + ["x", "y"] * 40
    texts = [" ".join(base), " ".join(base[:330] + [f"z{i}" for i in range(30)] + base[330:])]
    signature = minhash.signatures(*minhash.shingles(texts, 5), 2, 4096)
    exact = probability_jaccard(*map(profile, texts))
    assert (signature[0] == signature[1]).mean() == pytest.approx(exact, abs=0.04)


def test_classes_equal_brute_force(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    profiles = {i: profile(t) for i, t in texts.items()}
    holders, links = defaultdict(list), {i: i for i in texts}
    for i, p in profiles.items():
        for s in p:
            holders[s].append(i)

    def root(i):
        while links[i] != i:
            i = links[i]
        return i

    for a, b in {(min(x, y), max(x, y)) for h in holders.values() for x in h for y in h if x != y}:
        x, y = profiles[a], profiles[b]
        if len(x.keys() & y.keys()) >= 0.5 * min(len(x), len(y)) and probability_jaccard(x, y) >= 0.8 - 1e-12:
            low, high = sorted((root(a), root(b)))
            links[high] = low
    assert {r["doc_id"]: r["class_id"] for r in QUERIES["op1_near_copies"](spark, sf).collect()} == {i: root(i) for i in texts}


def test_a_group_whose_copies_differ_more_from_each_other(spark):
    """Chains whose ends are unlike, and a hub that is not the first of its group."""
    base = [f"w{i}" for i in range(300)]
    rows = [(100, " ".join(base))]
    for n in range(40):
        words = list(base)
        words[7 * n : 7 * n + 3] = [f"n{n}a", f"n{n}b", f"n{n}c"]
        words[(7 * n + 150) % 300] = f"m{n}"
        rows.append((n, " ".join(words)))
    rows += [(200, " ".join(base[:150] + [f"q{i}" for i in range(150)])), (201, " ".join(base[:150] + [f"q{i}" for i in range(148)] + ["r", "s"]))]
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {found[i] for i in [*range(40), 100]} == {0} and found[200] == found[201] == 200


def test_short_texts_of_one_crowded_bucket(spark):
    """Pairs of similarity 0.8 with few shingles, in a bucket whose first text is like none of them."""
    texts = [(0, "a text of other words")]
    for n in range(120):
        words = [f"w{n}x{k}" for k in range(9 + n % 2 * 5)]
        short = words[:8] if len(words) == 9 else words[:12]
        texts += [(2 * n + 1, " ".join(short)), (2 * n + 2, " ".join(words))]
    profiles = {i: profile(t) for i, t in texts}
    similar = {(i + 1, i) for i in range(1, 240, 2) if probability_jaccard(profiles[i], profiles[i + 1]) >= 0.8 - 1e-12}
    crowded = spark.createDataFrame([(1, 0, i) for i, _ in texts], "bucket long, pivot long, text_id long")
    tested = spark.createDataFrame([(i, 0, 0.0) for i, _ in texts[1:]], "a long, b long, similarity double")
    classes = spark.createDataFrame([], "id long, component long")
    met = minhash._other_pairs(crowded, tested, classes, spark.createDataFrame(texts, "doc_id long, text string"), minhash.NearCopies())
    assert len(similar) == 120 and similar <= {(r["a"], r["b"]) for r in met.collect()}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i + 1, i) for i in range(60)] + [(1000 + i, 500) for i in range(50)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[1000 + i] for i in range(50)} == {500}


def test_suffix_array_and_prefixes():
    random = np.random.default_rng(1)
    for trial in range(40):
        data = random.integers(0, 3, random.integers(1, 400)).astype(np.uint8)
        if trial % 3 == 0:
            data = np.concatenate([np.tile(data[:7], 20), data, data[:90], np.tile(data[:5], 15)])
        raw, order = bytes(data), suffix_array.suffix_array(data, 50)

        def head(i):
            return raw[i : i + 50].ljust(50, b"\0")

        assert list(order) == sorted(range(len(raw)), key=lambda i: (head(i), i)) or [head(i) for i in order] == sorted(map(head, range(len(raw))))
        shared = suffix_array.common_prefixes(data, order, 50)
        for k in range(1, len(order)):
            x, y = raw[order[k] :], raw[order[k - 1] :]
            n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert shared[k] == min(n, 50)


def test_merged_runs():
    random = np.random.default_rng(2)
    runs = [np.unique(random.integers(0, 300, 80)).astype(np.uint64) for _ in range(7)]
    keys, counts = suffix_array.merge_runs([(r, np.ones(len(r), np.int64)) for r in runs], np.add)
    assert dict(zip(keys.tolist(), counts.tolist())) == Counter(np.concatenate(runs).tolist()) and list(keys) == sorted(keys)


@pytest.mark.parametrize("sizes", [None, (60_000, 20_000, 15_000, 5, 1)])
def test_repeats_equal_brute_force(spark, sf, monkeypatch, sizes):
    if sizes:
        for name, value in zip(("SHARD_BYTES", "ARRAY_BYTES", "BUCKET_BYTES", "HOT", "SPARE_BITS"), sizes):
            monkeypatch.setattr(suffix_dedup, name, value)
    seen, wanted = {}, {}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    for row in sorted(docs, key=lambda r: r["doc_id"]):
        raw, own = (row["text"] or "").encode(), set()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if raw[p : p + 50] in seen:
                gone[p : p + 50] = True
            else:
                own.add(raw[p : p + 50])
        seen.update(dict.fromkeys(own))
        runs = int((np.diff(gone, prepend=False) & gone).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        wanted[row["doc_id"]] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    found = QUERIES["op4_suffix_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == wanted


def test_sketches_of_many_short_texts_take_little_memory():
    """A sketch has as many registers for a short text as for a long one, so parts are bounded by texts too."""
    texts = [" ".join(f"{n % 97}{k}" for k in range(100)) + f" {n}" for n in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    found = [row for out in minhash._sketch(5)(iter([batch])) for row in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [row["text_id"] for row in found] == list(range(1500))
    assert found[700:703] == [row for out in minhash._sketch(5)(iter([batch.slice(700, 3)])) for row in out.to_pylist()]
    assert peak < 60e6
