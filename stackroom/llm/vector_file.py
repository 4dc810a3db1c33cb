"""Exact top-k by inner product with vector-approximation files."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stackroom.llm.vector_blocks import Best, asked, blocked, met, searched, usable_vectors
from stackroom.plans.order import top_per_key
from stackroom.runtime import materialised

# Whole numbers per unit, cells per component, and exact vectors read at first per query.
SCALE, CELLS, FIRST_READ = 256, 64, 32
# Whole numbers of vectors in the files; scores of others are worked out without a bound on their size.
LARGEST = 1 << 26
# Vectors per block of those.
WIDE_ROWS = 512
# Queries whose bounds are held at once, and components of the exact vectors that are.
QUERY_ROWS, READ_CELLS = 256, 1 << 22


def whole_numbers(matrix: np.ndarray) -> np.ndarray:
    return np.floor(matrix * SCALE).astype(np.int64)


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers of ``LARGEST`` at most in the fewest bytes that hold them all."""
    return values.astype(np.int16 if np.abs(values).max(initial=0) < 1 << 15 else np.int32).tobytes()


def widened(data: bytes, rows: int, size: int) -> np.ndarray:
    return np.frombuffer(data, f"i{len(data) // (rows * size)}").reshape(rows, size)


def approximate(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
    """A block of the file: ids, exact vectors, and the quantised cell of every component between the block's bounds."""
    values = whole_numbers(matrix)
    low = values.min(axis=0)
    spread = values.max(axis=0) - low + 1
    cells = ((values - low) * CELLS // spread).astype(np.uint8)
    return {"ids": ids.astype(np.int64).tobytes(), "data": narrow(values), "cells": cells.tobytes(), "bounds": np.stack([low, spread]).tobytes()}


def encode_queries(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
    return {"ids": ids.astype(np.int64).tobytes(), "data": narrow(whole_numbers(matrix))}


def best_of_block(k: int):
    """The k best candidates per query over blocks, ties to smaller ids.

    The scan turns cells into an upper bound of each score. Exact vectors are read where the bound reaches the kth exact
    score so far; an equal bound is read too, as its row may have a smaller id. A query without k rows yet takes the
    kth score of those with the largest bounds.
    """

    def run(row: dict, best: Best | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = row["size"]
        ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
        best = best or Best(len(query_ids), k, np.int64)
        exact = widened(row["data"], len(ids), size)
        queries = widened(row["q_data"], len(query_ids), size).astype(np.int64)
        cells = np.frombuffer(row["cells"], np.uint8).reshape(len(ids), size).astype(np.int64)
        low, spread = np.frombuffer(row["bounds"], np.int64).reshape(2, size)
        lower, upper = low - (-cells * spread // CELLS), low - (-(cells + 1) * spread // CELLS) - 1
        # Twice the bound is the product with the sum of a cell's ends and, with the widest cell's width, a number per query.
        both, width = lower + upper, (upper - lower).max(axis=0)
        reach = int(np.abs(queries).sum(axis=1).max()) * int(np.abs(both).max(initial=1))
        # Sums of whole numbers are exact in a float type that holds the largest of them.
        kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
        scanned, held = np.ascontiguousarray(both.astype(kind).T), np.empty((min(QUERY_ROWS, len(queries)), len(ids)), kind)
        none, read = np.iinfo(np.int64).min, max(FIRST_READ, k + 1)
        last = best.last(none)
        for start in range(0, len(queries), QUERY_ROWS):
            q, own = queries[start : start + QUERY_ROWS], query_ids[start : start + QUERY_ROWS]
            floor = last[start : start + QUERY_ROWS]
            if kind is np.int64:
                bound = np.maximum(q, 0) @ upper.T + np.minimum(q, 0) @ lower.T
            else:
                bound = np.matmul(q.astype(kind), scanned, out=held[: len(q)])
            todo = np.flatnonzero(floor == none)
            if len(todo) and read < len(ids):
                at = np.argpartition(-bound[todo], read, axis=1)[:, :read]
                score = np.einsum("qrd,qd->qr", exact[at].astype(np.int64), q[todo])
                floor[todo] = np.sort(np.where(ids[at] == own[todo][:, None], none, score), axis=1)[:, -k]
            # No bound lies beyond the reach; within it, the number is exact in a float type.
            least = floor if kind is np.int64 else np.clip(2 * np.clip(floor, -(1 << 61), 1 << 61) - np.abs(q) @ width, -reach, reach + 1).astype(kind)
            some = np.flatnonzero(bound.max(axis=1) >= least)
            pairs, most = np.flatnonzero(bound[some] >= least[some][:, None]), max(1, READ_CELLS // size)
            for a in range(0, len(pairs), most):
                i, r = np.divmod(pairs[a : a + most], len(ids))
                i = some[i]
                score = np.einsum("pd,pd->p", exact[r].astype(np.int64), q[i])
                keep = (ids[r] != own[i]) & (score >= floor[i])
                best.add(start + i[keep], ids[r[keep]], score[keep])
        return best.rows(query_ids)

    return run


def plain(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
    return {"ids": ids.astype(np.int64).tobytes(), "data": matrix.astype(np.float64).tobytes()}


def unbounded(matrix: np.ndarray) -> np.ndarray:
    """``whole_numbers`` as Python's integers; doubles from 2**53 on are whole already."""
    whole = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in matrix.ravel().tolist()]
    return np.array(whole, object).reshape(matrix.shape)


def best_of_wide_block(k: int):
    """The k best candidates per query over blocks among those whose score is a long, ties to smaller ids."""

    def run(row: dict, best: Best | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = row["size"]
        ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
        best = best or Best(len(query_ids), k, np.int64)
        exact, queries = (np.frombuffer(row[c], np.float64).reshape(-1, size) for c in ("data", "q_data"))
        # One more for rounding down.
        reach = (int(np.abs(exact).max()) + 1) * (int(np.abs(queries).max()) + 1) * SCALE * SCALE * size
        fits = reach < 1 << 63
        exact, queries = (whole_numbers(exact), whole_numbers(queries)) if fits else (unbounded(exact), unbounded(queries))
        for i, (own, q) in enumerate(zip(query_ids, queries)):
            score, keep = exact @ q, ids != own
            if not fits:
                keep &= np.array([-(1 << 63) <= s < 1 << 63 for s in score], bool)
            score, other = score[keep].astype(np.int64), ids[keep]
            # Not the negative of a score, which may not be a long.
            order = np.lexsort((other, ~score))[:k]
            best.add(np.full(len(order), i), other[order], score[order])
        return best.rows(query_ids)

    return run


def in_reach(vector: Column) -> Column:
    """Scores of any two such vectors are far from the ends of a long."""
    most = F.least(F.lit(float(LARGEST)), F.sqrt(F.lit(2.0**62) / F.size(vector)))
    return F.forall(vector, lambda x: F.abs(x * SCALE) < most)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k best rows by integer inner product for every query row: (query_id, rank, vec_id, score).

    Components are floor(256 * x). ``is_query`` is a condition on ``vec_id`` that states the queries; all other ids of the same
    vector length are candidates, ties go to the smaller id, and fewer than k candidates are all returned. Each
    block of candidates is a vector-approximation file that is scanned for every query; only the k best per
    query and task are shuffled. Results are exact.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do null ids. Rows that share an
    id count once, with their smallest vector. An empty table gives no rows.

    Pairs with a vector of components so large (2**18 and more) that a score may not fit a long are scored one by one in
    whole numbers of any size; only a pair whose score is not a long is left out.
    """
    usable = materialised(usable_vectors(vectors, vec_id, vector, lambda v: F.lit(True)))
    small, wide = usable.filter(in_reach(F.col("v"))), usable.filter(~in_reach(F.col("v")))
    candidates = blocked(small, approximate, ["ids", "data", "cells", "bounds"])
    queries = asked(small.filter(is_query), encode_queries)
    best = searched(met(candidates, queries), best_of_block(k), k, "long")
    if wide.limit(1).count():

        def pairs(candidates: DataFrame, queries: DataFrame) -> DataFrame:
            files = blocked(candidates, plain, ["ids", "data"], WIDE_ROWS)
            return searched(met(files, asked(queries.filter(is_query), plain)), best_of_wide_block(k), k, "long")

        best = best.unionByName(pairs(usable, wide)).unionByName(pairs(wide, small))
    order = [F.col("score").desc(), F.col("vec_id")]
    top = top_per_key(best, ["query_id"], order, k)
    return top.select("query_id", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).alias("rank"), "vec_id", "score")


def top_k_sql(divisor: int = 50, k: int = 5) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {divisor} = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
