"""Blocks of vectors for searches of a stated query set against all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.runtime import materialised

# Vectors per block.
BLOCK_ROWS = 4096
# Components of the queries that are dealt to a block, and blocks of candidates that a task searches, on average.
QUERY_CELLS, TASK_BLOCKS = 1 << 19, 128
# Tasks per core that a search of few blocks is cut into.
TASKS_PER_CORE = 4


def finite(vector: Column) -> Column:
    """No null and no NaN or infinity among the components (and at least one)."""
    good = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def usable_vectors(rows: DataFrame, vec_id: str, vector: str, holds: Callable[[Column], Column]) -> DataFrame:
    """(vec_id, v) as doubles for rows that hold; of rows that share an id the smallest vector counts, once."""
    read = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    read = read.filter(F.col("vec_id").isNotNull() & finite(F.col("v"))).filter(holds(F.col("v")))
    return read.groupBy("vec_id").agg(F.min("v").alias("v"))


def block_batches(batches: Iterator[pa.RecordBatch], rows: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of some ``rows`` vectors of one length, or twice ``QUERY_CELLS`` components, in the order of their ids."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def out(size: int) -> tuple[np.ndarray, np.ndarray]:
        parts = held.pop(size)
        ids, matrix = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(ids, kind="stable")
        return ids[order], matrix[order]

    for batch in batches:
        all_ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            matrix = flat[starts[at][:, None] + np.arange(size)]
            most = rows or max(1, 2 * QUERY_CELLS // int(size))
            for a in range(0, len(at), most):
                held.setdefault(int(size), []).append((all_ids[at][a : a + most], matrix[a : a + most]))
                if sum(len(p[0]) for p in held[int(size)]) >= most:
                    yield out(int(size))
    for size in list(held):
        yield out(size)


def blocked(vectors: DataFrame, encode: Callable[[np.ndarray, np.ndarray], dict[str, bytes]], columns: list[str], rows: int | None = BLOCK_ROWS) -> DataFrame:
    """A table with one row per block: its vector length and what ``encode`` makes of (ids, matrix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, matrix in block_batches(batches, rows):
            made = encode(ids, matrix)
            yield pa.RecordBatch.from_arrays([pa.array([matrix.shape[1]], pa.int32()), *[pa.array([made[c]], pa.binary()) for c in columns]], ["size", *columns])

    schema = ", ".join(["size int", *[f"{c} binary" for c in columns]])
    return materialised(vectors.select("vec_id", "v").mapInArrow(run, schema))


def asked(queries: DataFrame, encode: Callable[[np.ndarray, np.ndarray], dict[str, bytes]]) -> DataFrame:
    """Blocks of queries with their ids and data.

    Queries are a few of the rows in every file; they are dealt anew, so that blocks are few and full.
    """
    rows = materialised(queries.select("vec_id", "v"))
    cells = rows.agg(F.sum(F.size("v"))).first()[0] or 0
    return blocked(rows.repartition(max(1, -(-cells // QUERY_CELLS))), encode, ["ids", "data"], None)


def met(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """Each block of candidates with each block of queries of the same vector length.

    Each task reads some blocks of either table where they lie: nothing is shuffled, copied or sent to the driver. The hint also
    keeps Spark from a broadcast, which would be chosen by the size of compressed files.
    """
    cores = candidates.sparkSession.sparkContext.defaultParallelism
    groups = max(-(-candidates.count() // TASK_BLOCKS), -(-TASKS_PER_CORE * cores // max(1, queries.count())), 1)
    sent = queries.select(F.col("size").alias("q_size"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    return candidates.coalesce(groups).hint("shuffle_replicate_nl").join(sent, F.col("size") == F.col("q_size")).drop("q_size")


class Best:
    """The k best rows of each query so far, ties to smaller ids: whole scores from the largest, distances from the least."""

    def __init__(self, queries: int, k: int, kind: type):
        self.k, self.count = k, np.zeros(queries, np.int64)
        self.ids, self.scores = np.zeros((queries, k), np.int64), np.zeros((queries, k), kind)

    def last(self, none: float) -> np.ndarray:
        """The kth score of each query, ``none`` where there are fewer."""
        return np.where(self.count == self.k, self.scores[:, -1], none)

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Rows, none of which was added before, for the queries ``at``."""
        if not len(at):
            return
        own = np.unique(at)
        held = np.arange(self.k) < self.count[own][:, None]
        at = np.concatenate([np.repeat(own, self.count[own]), at])
        ids = np.concatenate([self.ids[own][held], ids])
        scores = np.concatenate([self.scores[own][held], scores])
        # Not the negative of a score, which may not be a long.
        order = np.lexsort((ids, ~scores if scores.dtype == np.int64 else scores, at))
        at = at[order]
        first = np.searchsorted(at, own)
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        keep = rank < self.k
        self.ids[at[keep], rank[keep]] = ids[order][keep]
        self.scores[at[keep], rank[keep]] = scores[order][keep]
        self.count[own] = np.minimum(np.diff(np.append(first, len(at))), self.k)

    def rows(self, query_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = np.arange(self.k) < self.count[:, None]
        return np.repeat(query_ids, self.count), self.ids[held], self.scores[held]


def searched(pairs: DataFrame, search: Callable[[dict, Best], object], k: int, score: str) -> DataFrame:
    """Best rows of every query over the blocks of a task: (query_id, vec_id, score).

    ``search`` adds the rows of a pair of blocks; rows beyond the kth that a query has already may be left out.
    """
    kind = {"long": np.int64, "double": np.float64}[score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i] for c, name in enumerate(batch.schema.names)}
                row = {name: x.as_py() if name in ("size", "q_ids") else x.as_buffer() for name, x in row.items()}
                search(row, best.setdefault(row["q_ids"], Best(len(row["q_ids"]) // 8, k, kind)))
            # Else these stay while the next are read.
            batch = row = None
        for ids, found in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.rows(np.frombuffer(ids, np.int64))], ["query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, f"query_id long, vec_id long, score {score}")
