import math
import operator
import sys
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stackroom.llm import packing, projected, quality, toxicity, vector_file
from stackroom.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op9_toxicity"](spark, LARGER).collect() if r["doc_id"] in truth and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    toxic = [r["predicted"] for r in rows if truth[r["doc_id"]]]
    clean = [r["predicted"] for r in rows if not truth[r["doc_id"]]]
    assert np.mean(toxic) >= 0.6 and np.mean(clean) <= 0.03


def test_quality_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_quality_network"](spark, LARGER).collect() if r["doc_id"] in truth and r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows]) >= 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_chunks_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 488, 489, 5000):
        chunks, counts = quality.chunks_of(["a" * n])
        assert len(chunks) == counts[0] and (counts[0] - 1) * quality.HOP + quality.CHUNK >= n
        assert (chunks != 0).any(axis=1).sum() == (counts[0] if n else 0)


def test_gradients_of_the_network():
    random = np.random.default_rng(5)
    net = quality.fit(["ab" * 200, "xyz!" * 150], np.array([1.0, 0.0]), 0.5, epochs=1)
    chunks, counts = quality.chunks_of(["".join(map(chr, random.integers(32, 127, 700))), "q" * 300])
    truth = np.array([1.0, 0.0])
    slopes = quality._slopes(net, chunks, counts, truth)

    def loss():
        p = quality.sigmoid((quality.combined(quality.pooled(net, chunks)[0], counts) @ net.top + net.intercept[0]).astype(float))
        return -np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p))

    for parameter, slope in list(zip(net.learned, slopes))[2:]:
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept, step = parameter[at], 1e-2
        parameter[at] = kept + step
        up = loss()
        parameter[at] = kept - step
        down = loss()
        parameter[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(slope[at], rel=0.1, abs=1e-3)


def test_ngrams_ignore_case_and_marks():
    hits = [set(zip(*(x.tolist() for x in toxicity.ngram_hits([t])))) for t in ("You CLOWN!!", "you clown ", " you, clown")]
    assert hits[0] == hits[1] == hits[2]


def test_one_class_gives_the_prior():
    assert toxicity.scorer(toxicity.fit(["a"], np.array([0.0]), 0.0))(["b", ""]) == pytest.approx([1e-4, 1e-4], rel=1e-3)


def test_neighbours_recall(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{LARGER}/embeddings.parquet").collect()}
    found = defaultdict(dict)
    for r in QUERIES["op10_projected_neighbours"](spark, LARGER).collect():
        found[r["query_id"]][r["vec_id"]] = r["score"]
    hits = total = 0
    for query in (i for i in rows if i % 100 == 0):
        distance = {i: float(np.sqrt(((v - rows[query]) ** 2).sum())) for i, v in rows.items() if i != query}
        best = sorted(distance, key=lambda i: (distance[i], i))[:10]
        hits, total = hits + len(found[query].keys() & set(best)), total + 10
        assert all(score == pytest.approx(distance[i], rel=1e-12) for i, score in found[query].items())
    assert hits / total >= 0.9


def test_search_of_a_block_stops_early():
    random = np.random.default_rng(3)
    centres = random.normal(0, 40, (50, 6))
    matrix = (centres[:, None] + random.normal(0, 0.1, (50, 40, 6))).reshape(-1, 6)
    row = {**projected.index_block(np.arange(len(matrix)), matrix), "size": 6}
    asked = projected.encode_queries(np.array([5]), matrix[[5]])
    row |= {"q_ids": asked["ids"], "q_data": asked["data"]}
    _, ids, scores = projected.near_in_block(10, 0.97)(row)
    distance = np.sqrt(((matrix - matrix[5]) ** 2).sum(axis=1))
    assert set(ids) <= set(range(40)) and list(scores) == sorted(scores) and scores[-1] <= np.sort(distance)[14]


def test_large_components_take_part(spark):
    """Components beyond 2**18 in queries and candidates, up to scores that are no long."""
    random = np.random.default_rng(8)
    rows = [(i, [float(x) for x in random.normal(size=4) * 2.0 ** (0, 0, 18.5, 21, 27, 60, 900, 1013)[i % 8]]) for i in range(64)]
    rows += [(64, [0.0, 0.0, 0.0, 1.0]), (65, [1e300, -1e300, 2.0**300, 0.5]), (66, [-(2.0**27), 0.0, 0.0, 0.0]), (67, [2.0**20, 0.0, 0.0, 0.0])]
    whole = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v in rows}
    wanted = set()
    for i, v in whole.items():
        scores = sorted((-sum(map(operator.mul, v, w)), j) for j, w in whole.items() if i != j)
        inside = [(-s, j) for s, j in scores if -(1 << 63) <= -s < 1 << 63][:5]
        wanted |= {(i, rank, j, s) for rank, (s, j) in enumerate(inside, 1)}
    # The least long is a score.
    assert sum(map(operator.mul, whole[66], whole[67])) == -(1 << 63)
    found = vector_file.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.lit(True))
    assert {tuple(r) for r in found.collect()} == wanted


def test_chi_square_closed_form():
    draws = (np.random.default_rng(4).normal(size=(200_000, 8)) ** 2).sum(axis=1)
    for x in (2.0, 8.0, 15.0):
        assert projected.chi_square(x, 8) == pytest.approx((draws <= x).mean(), abs=0.01)


def test_packing_round_trip(spark, sf):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {r["doc_id"]: np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op8_retrieval_packing"](spark, sf).collect():
        ids = docs[r["doc_id"]]
        assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for runs, sizes in ((pieces, {i: len(x) for i, x in docs.items()}), (sequences, None)):
        for name, parts in runs.items():
            end = 0
            for start, size in sorted(parts):
                assert start == end
                end += size
            assert end == sizes[name] if sizes else end == 2048 or end & (end - 1) == 0 and end < 2048
    assert pieces.keys() == docs.keys()


def test_windows_hold_neighbours():
    """Documents of two topics: a window is filled from its seed's topic."""
    random = np.random.default_rng(6)
    ids = [random.integers(1000 * (n % 2), 1000 * (n % 2) + 300, 100).astype(np.uint32) for n in range(40)]
    pool = [packing.Piece(i, 0, 100) for i in range(40)]
    windows, left = packing.fill(pool, ids, np.full(2000, 2.0), 100.0, 500)
    pure = [len({p.doc % 2 for p in w}) == 1 for w in windows]
    assert len(windows) == 8 and np.mean(pure) >= 0.75 and not left
    assert all(sum(p.size for p in w) == 500 for w in windows)


def test_all_terms_of_a_seed_count():
    """Documents of many terms, a quarter of them frequent, against BM25 by definition."""
    random = np.random.default_rng(7)
    ids = [np.concatenate([random.integers(0, 40, 60), random.integers(40, 900, 80)]).astype(np.uint32) for _ in range(60)]
    # Shares only the lightest terms of the first document.
    idf = np.linspace(1.0, 3.0, 900)
    ids.append(np.sort(np.unique(ids[0]))[:20])
    index = packing.Index(ids, idf, 130.0)
    unused = np.ones(len(ids), bool)
    for seed in (0, 17, 60):
        scores = []
        for other in ids:
            counts = {t: (other == t).sum() for t in set(ids[seed].tolist()) & set(other.tolist())}
            norm = packing.K1 * (1 - packing.B + packing.B * len(other) / 130.0)
            scores.append(sum(idf[t] * n * (packing.K1 + 1) / (n + norm) for t, n in counts.items()))
        assert index.scores(seed) == pytest.approx(np.array(scores), abs=1e-9)
        assert list(index.neighbours(seed, unused)) == [i for i in np.argsort(-np.array(scores), kind="stable") if scores[i] > 0]


def test_ids_of_words_by_parts():
    """Letters and marks apart, cases, scripts, blanks and other words: the ids of the whole tokenizer, new or remembered."""
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, tokens = Tokenizer.from_file(path), packing.Tokens(path)
    texts = ["", " ", "Über ÜBER über,", "straße STRASSE! ÿ Ÿ", "a-b it's (x) ...", "x² ﬁne Ⅷ ı İ ª º", "日本 кот КОТ é e\u0301", "a\nb\r\nc\td", "w1 Zz]]^\\ `q~ $5", "!?", "\x00a a\u00a0b", "ÀÖØß÷×", "aB" * 300]
    for _ in range(2):
        assert [x.tolist() for x in tokens.of(pa.array(texts), 1)] == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def test_worker_keeps_its_tokenizer():
    """A Python worker's next tasks take the words it has learned, and other files their own."""
    path = public_tokenizers.path("word_bpe_49k.json")
    held = packing.tokens_at(path)
    held.of(pa.array(["one two, three"]), 1)
    assert packing.tokens_at(path) is held and {"one", "two", ","} <= held.known.keys()


def test_later_steps_do_not_carry_the_words():
    """Once all texts have their ids, a worker gives back its tokenizer and the words it has learned."""
    path = public_tokenizers.path("word_bpe_49k.json")
    held = packing.tokens_at(path)
    held.of(pa.array(["one two, three"]), 1)
    batch = pa.RecordBatch.from_arrays([pa.array([3]), pa.array([np.array([7, 9, 7], "<u2").tobytes()])], ["n", "ids"])
    assert [b.to_pylist() for b in packing._counts(iter([batch]))] == [[{"id": 7, "n": 1}, {"id": 9, "n": 1}]]
    assert packing.HELD not in sys.modules
    assert packing.tokens_at(path) is not held
