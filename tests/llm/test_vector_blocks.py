"""Searches of blocks of vectors by blocks of queries: what moves, and what is kept from block to block."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackroom.llm import projected, vector_file
from stackroom.llm.vector_blocks import Best, asked, blocked, met


def unit_vectors(count, size, seed):
    rows = np.random.default_rng(seed).normal(size=(count, size))
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def table(spark, matrix):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<double>")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_copies_of_queries_reach_the_driver(spark):
    """A few queries are below Spark's limit for broadcasts, but not their copies for every partition."""
    frame = vector_file.exact_top_k(table(spark, unit_vectors(300, 8, 1)), F.col("vec_id") % 50 == 0)
    assert "Broadcast" not in plan_of(frame) and "Generate" not in plan_of(frame)
    assert frame.count() == 6 * 5


def test_each_pair_of_blocks_meets_once(spark):
    rows = table(spark, np.arange(1200.0).reshape(600, 2)).withColumnRenamed("embedding", "v").repartition(3)
    rows = rows.unionByName(spark.createDataFrame([(600 + i, [1.0, 2.0, float(i)]) for i in range(50)], "vec_id long, v array<double>"))
    candidates = blocked(rows, vector_file.approximate, ["ids", "data", "cells", "bounds"], 64)
    queries = asked(rows.filter(F.col("vec_id") % 10 == 0), vector_file.encode_queries)
    assert queries.count() == 2
    pairs = [(r["size"], i, q) for r in met(candidates, queries).collect() for i in np.frombuffer(r["ids"], np.int64) for q in np.frombuffer(r["q_ids"], np.int64)]
    assert len(pairs) == len(set(pairs)) == 600 * 60 + 50 * 5


def test_best_rows_of_queries():
    best = Best(3, 2, np.int64)
    for at, ids, scores in (([0, 0, 0, 2], [5, 4, 9, 1], [7, 7, -1 << 63, -1 << 63]), ([0, 2, 2], [3, 8, 7], [7, 2, 1])):
        best.add(*map(np.array, (at, ids, scores)))
    assert [x.tolist() for x in best.rows(np.array([10, 11, 12]))] == [[10, 10, 12, 12], [3, 4, 8, 7], [7, 7, 2, 1]]
    assert best.last(0).tolist() == [7, 0, 1]


@pytest.mark.parametrize("scale", [1, 40, 1e5])
def test_blocks_with_what_others_found_are_exact(scale):
    """Equal scores, repeated vectors and components that need floats, doubles and longs."""
    matrix = np.concatenate([unit_vectors(400, 16, 2), np.repeat(unit_vectors(4, 16, 3), 50, axis=0)])[np.random.default_rng(4).permutation(600)] * scale
    whole = np.floor(matrix * 256).astype(np.int64)
    asking = np.arange(0, 600, 7)
    best = Best(len(asking), 6, np.int64)
    sent = vector_file.encode_queries(asking, matrix[asking])
    for ids in np.array_split(np.arange(600), 4):
        row = {**vector_file.approximate(ids, matrix[ids]), "size": 16, "q_ids": sent["ids"], "q_data": sent["data"]}
        found = vector_file.best_of_block(6)(row, best)
    scores = whole[asking] @ whole.T
    wanted = [(q, j, scores[i, j]) for i, q in enumerate(asking) for j in sorted(set(range(600)) - {q}, key=lambda j: (-scores[i, j], j))[:6]]
    assert list(zip(*found)) == wanted


def test_no_copies_of_queries_of_neighbours_reach_the_driver(spark):
    frame = projected.nearest(table(spark, unit_vectors(300, 8, 1)), F.col("vec_id") % 50 == 0)
    assert "Broadcast" not in plan_of(frame) and "Generate" not in plan_of(frame)
    assert frame.count() == 6 * 10


def crowded(random):
    return np.repeat(unit_vectors(40, 6, 7), 50, axis=0)[random.permutation(2000)]


@pytest.mark.parametrize(
    "make",
    [
        lambda random: unit_vectors(2000, 24, 6),
        lambda random: np.round(random.normal(size=(2000, 3)), 1),
        lambda random: random.normal(0, 3, (30, 12))[random.integers(0, 30, 2000)] + random.normal(0, 0.01, (2000, 12)),
        lambda random: unit_vectors(2000, 8, 6) * 0.01 + 1e4,
        lambda random: random.normal(size=(2000, 5)) * 2.0 ** random.integers(-30, 30, (2000, 1)),
        crowded,
    ],
)
def test_products_find_what_the_leaves_do(make, monkeypatch):
    """The same rows and distances as with the leaves opened one after the other, block by block."""
    matrix = make(np.random.default_rng(6))
    asking = np.arange(0, 2000, 9)
    sent = projected.encode_queries(asking, matrix[asking])
    blocks = [{**projected.index_block(ids, matrix[ids]), "size": matrix.shape[1], "q_ids": sent["ids"], "q_data": sent["data"]} for ids in np.array_split(np.arange(2000), 3)]

    def searched():
        best = Best(len(asking), 10, np.float64)
        for row in blocks:
            found = projected.near_in_block(10, 0.97)(row, best)
        return list(zip(*(x.tolist() for x in found)))

    fast = searched()
    monkeypatch.setattr(projected, "products", lambda data, queries: (data, queries, np.zeros(len(queries)), np.full(len(queries), np.inf), 1.0))
    assert fast == searched() and len(fast) == 10 * len(asking)


def test_ring_of_a_confidence():
    ring = projected.ring_of(0.97)
    assert projected.chi_square(ring, projected.DIMENSIONS) >= 0.97 > projected.chi_square(np.nextafter(ring, 0), projected.DIMENSIONS)
    assert projected.ring_of(2) == np.inf
