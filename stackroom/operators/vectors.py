"""Vector table: lookup, insert, embedding, exact top-k."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions.arrays import cosine_similarity
from stackroom.plans.order import top_per_key
from stackroom.plans.skew import join_per_key
from stackroom.runtime import materialised

# Scores are compared at this precision, so that equal vectors tie and the id decides.
SCORE_DIGITS = 9
# Longest result list that every task keeps for itself.
HEAP_ROWS = 10_000
# Pivots per embedding length, and bytes of all pivots, which every task holds.
PIVOTS, PIVOT_BYTES = 1024, 32 << 20
# Vectors, and bytes of queries as doubles, that meet in one task.
SLICE_ROWS, QUERY_BYTES = 50_000, 64 << 20
# Slack of bounds in radians, for the rounding of angles and scores.
SLACK = 1e-6
BEST_SCHEMA = "query_id string, record_id string, score double"
# Length that stands for vectors and queries without a direction.
NO_DIRECTION = -1


def vector_get(vectors: DataFrame, record: str, pos: str = "pos") -> DataFrame:
    """Embedding of the first inserted vector of a record; no row when it is unknown."""
    found = vectors.filter(F.col("record_id") == record)
    return found.groupBy("record_id").agg(F.min_by("embedding", pos).alias("embedding"))


def vector_insert(vectors: DataFrame, new: DataFrame, pos: str = "pos") -> DataFrame:
    """Append vectors; positions of the new rows continue after the table's last one."""
    top = F.coalesce(vectors.agg(F.max(pos)).scalar(), F.lit(-1)) + 1
    return vectors.unionByName(new.withColumn(pos, F.col(pos) + top))


def vector_top_k(vectors: DataFrame, query: Sequence[float], limit: int) -> DataFrame:
    """Best cosine scores over the whole table, ties by record id.

    The scan multiplies Arrow batches and keeps ``limit`` rows per task; for a very long list all rows are
    scored, by the same function, and sorted by the engine.
    """
    found = vectors.select(F.col("record_id").cast("string").alias("record_id"), "embedding")
    kept = limit if limit <= HEAP_ROWS else None
    scored = _scored(found, _by_width([""], [list(query)]), kept).select("record_id", "score")
    return scored.orderBy(F.desc("score"), F.col("record_id")).limit(max(limit, 0))


def _scores(queries: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Cosine of each query (rows) with each embedding (columns); 0 where the length or a norm does not fit."""
    dim = queries.shape[1]
    scores = np.zeros((len(queries), len(lists)))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(sizes == dim) if dim else np.array([], dtype=int)
    if not len(fits):
        return scores
    flat = lists.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dim)
    norms = np.outer(np.linalg.norm(queries, axis=1), np.linalg.norm(flat, axis=1))
    dots = queries @ flat.T
    scores[:, fits] = np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
    return np.round(scores, SCORE_DIGITS)


def _best(scores: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``limit`` by score, then id."""
    if len(scores) > limit:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - limit)[len(scores) - limit])
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))[:limit]
    return scores[order], ids[order]


def vector_top_k_batch(vectors: DataFrame, queries: DataFrame, limit: int) -> DataFrame:
    """Exact best scores per query: ``query_id, record_id, score``.

    A sample of the vectors are pivots; every vector is put once into the cluster of its nearest pivot, whose radius is the
    largest angle in it. The angle between directions is a metric, so no member of a cluster is nearer to a query than
    the pivot's angle less the radius. A query first meets its nearest clusters, as many as hold ``limit`` vectors;
    then those whose bound does not rule out a score as good as its ``limit``-th best so far. Clusters and their
    queries meet in blocks of a bounded size; the vectors are read from one table and only copied where a block
    has more than ``QUERY_BYTES`` of queries.

    Vectors of another length than the query and those without a direction score 0, as all do for a query without one.
    """
    if limit <= 0:
        return vectors.sparkSession.createDataFrame([], BEST_SCHEMA)
    wanted = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    wanted = materialised(wanted.withColumn("width", _width()))
    found = vectors.select(F.col("record_id").cast("string").alias("record_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    found = materialised(found.withColumn("width", _width()))
    widths = [r["width"] for r in wanted.select("width").distinct().collect()]
    nothing = _without_direction(found, widths, limit)
    zeros = wanted.select("query_id", "width").join(nothing, "width").select("query_id", "record_id", F.lit(0.0).alias("score"))
    pivots = _pivots(found, [w for w in widths if w != NO_DIRECTION])
    if not pivots:
        return top_per_key(zeros, ["query_id"], [F.desc("score"), F.col("record_id")], limit)
    held = found.sparkSession.sparkContext.broadcast(pivots)
    schema = "record_id string, embedding array<double>, width int, cluster int, angle double"
    placed = materialised(found.filter(F.col("width").isin(list(pivots))).mapInArrow(_clustered(held), schema))
    stats = placed.groupBy("width", "cluster").agg(F.count(F.lit(1)).alias("rows"), F.max("angle").alias("radius")).collect()
    clusters = {(r["width"], r["cluster"]): (r["rows"], r["radius"]) for r in stats}
    known = found.sparkSession.sparkContext.broadcast(clusters)
    visit = "query_id string, embedding array<double>, width int, cluster int"
    directed = wanted.filter(F.col("width").isin(list(pivots)))
    near = materialised(directed.withColumn("least", F.lit(None).cast("double")).mapInArrow(_visits(held, known, limit), visit))
    first = materialised(_best_of_visits(placed, near, clusters, limit))
    best = top_per_key(first, ["query_id"], [F.desc("score"), F.col("record_id")], limit)
    least = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("_rows"), F.min("score").alias("least")).filter(F.col("_rows") >= limit)
    # A query with fewer rows has met all its clusters.
    more = materialised(directed.join(least.select("query_id", "least"), "query_id").select("query_id", "embedding", "width", "least").mapInArrow(_visits(held, known, limit), visit))
    rest = _best_of_visits(placed, more, clusters, limit)
    scored = first.unionByName(rest).unionByName(zeros)
    return top_per_key(scored, ["query_id"], [F.desc("score"), F.col("record_id")], limit)


def _width() -> Column:
    """Length of an embedding that has a direction, else ``NO_DIRECTION``."""
    squares = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x)
    return F.when((squares > 0) & (squares < float("inf")), F.size("embedding")).otherwise(NO_DIRECTION)


def _without_direction(found: DataFrame, widths: list[int], limit: int) -> DataFrame:
    """For each length of queries the first ids of the vectors that score 0 with them."""
    ids = materialised(top_per_key(found.select("width", "record_id"), ["width"], ["record_id"], limit))
    parts = [ids.filter((F.col("width") != w) | (F.lit(w) == NO_DIRECTION)).select(F.lit(w).alias("width"), "record_id") for w in widths]
    none = ids.limit(0).select("width", "record_id")
    return top_per_key(reduce(DataFrame.unionByName, parts, none), ["width"], ["record_id"], limit)


def _pivots(found: DataFrame, widths: list[int]) -> dict[int, np.ndarray]:
    """Unit vectors per length: those with the smallest hashes of their ids, at most ``PIVOT_BYTES`` in all."""
    pivots = {}
    for width in widths:
        rows = max(1, min(PIVOTS, PIVOT_BYTES // (8 * width * len(widths))))
        own = found.filter(F.col("width") == width).select("embedding", F.xxhash64("record_id", "embedding").alias("_h")).distinct()
        matrix = np.array([r["embedding"] for r in own.orderBy("_h").limit(rows).collect()], dtype="float64")
        if len(matrix):
            pivots[width] = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    return pivots


def _units(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch with embeddings of a length, and their unit vectors."""
    rows = np.flatnonzero(batch.column("width").to_numpy(zero_copy_only=False) == width)
    flat = batch.column("embedding").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return rows, flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def _clustered(pivots):
    """Rows with their nearest pivot and the angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, angle = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for width, matrix in pivots.value.items():
                rows, units = _units(batch, width)
                if len(rows):
                    angles = _angles(units, matrix)
                    nearest[rows], angle[rows] = angles.argmin(axis=1), angles.min(axis=1)
            columns = [batch.column("record_id"), batch.column("embedding"), batch.column("width"), pa.array(nearest), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, ["record_id", "embedding", "width", "cluster", "angle"])

    return run


def _visits(pivots, clusters, limit: int):
    """Clusters that a query has to meet, a row each.

    Without a ``least`` score these are the nearest ones that hold ``limit`` vectors together. With one they are the
    others whose bound reaches it.
    """
    names = ["query_id", "embedding", "width", "cluster"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = {}
        for width in pivots.value:
            nos = np.array(sorted(c for w, c in clusters.value if w == width), np.int64)
            shapes[width] = nos, *(np.array([clusters.value[width, c][i] for c in nos.tolist()]) for i in (0, 1))
        for batch in batches:
            least = batch.column("least").to_pylist()
            found_rows, found_clusters = [], []
            for width, matrix in pivots.value.items():
                nos, sizes, radii = shapes[width]
                rows, units = _units(batch, width)
                if not len(rows) or not len(nos):
                    continue
                bounds = np.maximum(0.0, _angles(units, matrix[nos]) - radii - SLACK)
                for row, bound in zip(rows.tolist(), bounds):
                    order = np.argsort(bound, kind="stable")
                    first = int(np.searchsorted(np.cumsum(sizes[order]), limit)) + 1
                    chosen = order[:first]
                    if least[row] is not None:
                        rest = order[first:]
                        chosen = rest[np.cos(bound[rest]) >= least[row] - 10.0**-SCORE_DIGITS]
                    found_rows += [row] * len(chosen)
                    found_clusters += nos[chosen].tolist()
            own = batch.select(["query_id", "embedding", "width"]).take(pa.array(found_rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found_clusters, pa.int32())], names)

    return run


def _best_of_visits(placed: DataFrame, visits: DataFrame, clusters: dict, limit: int) -> DataFrame:
    """Best rows per query and block of its clusters."""
    crowds = {(r["width"], r["cluster"]): r["rows"] for r in visits.groupBy("width", "cluster").agg(F.count(F.lit(1)).alias("rows")).collect()}
    shape = [(w, c, -(-clusters[w, c][0] // SLICE_ROWS), -(-n * 8 * w // QUERY_BYTES)) for (w, c), n in crowds.items()]
    # One row per visited cluster, at most as many as there are pivots.
    shapes = placed.sparkSession.createDataFrame(shape, "width int, cluster int, parts int, crowds int")
    on, keys = ["width", "cluster"], ["width", "cluster", "part", "crowd"]
    part, crowd = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)).alias("crowd")
    own_part = F.pmod(F.xxhash64("record_id"), F.col("parts")).cast("int").alias("part")
    own_crowd = F.pmod(F.xxhash64("query_id"), F.col("crowds")).cast("int").alias("crowd")
    left = visits.join(shapes, on).select(*on, "query_id", "embedding", part, own_crowd)
    right = placed.join(shapes, on).select(*on, "record_id", "embedding", own_part, crowd)

    def best_of_pair(block: pa.Table, rows: pa.Table) -> pa.Table:
        best: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        if block.num_rows and rows.num_rows:
            groups = _by_width(block.column("query_id").to_pylist(), block.column("embedding").to_pylist())
            ids = np.array(rows.column("record_id").to_pylist(), dtype=str)
            _merge(best, groups, ids, rows.column("embedding").combine_chunks(), limit)
        return _best_table(best)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_of_pair, BEST_SCHEMA)


def _by_width(names: list[str], lists: list[list[float] | None]) -> list[tuple[list[str], np.ndarray]]:
    """Query names and matrix per embedding length."""
    groups: dict[int, tuple[list[str], list[list[float]]]] = {}
    for name, values in zip(names, lists):
        members = groups.setdefault(len(values or []), ([], []))
        members[0].append(name)
        members[1].append(values or [])
    return [(n, np.array(v, dtype="float64").reshape(len(n), width)) for width, (n, v) in groups.items()]


def _best_table(best: dict[str, tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    names = [name for name, (_, ids) in best.items() for _ in ids]
    ids = [i for _, kept in best.values() for i in kept.tolist()]
    scores = np.concatenate([s for s, _ in best.values()]) if best else np.zeros(0)
    return pa.table({"query_id": pa.array(names, pa.string()), "record_id": pa.array(ids, pa.string()), "score": scores})


def _merge(best: dict, groups: list, ids: np.ndarray, lists: pa.Array, limit: int) -> None:
    for names, matrix in groups:
        for name, row in zip(names, _scores(matrix, lists)):
            scores, kept = best.get(name, (np.zeros(0), np.array([], dtype=str)))
            best[name] = _best(np.concatenate([scores, row]), np.concatenate([kept, ids]), limit)


def _scored(vectors: DataFrame, groups: list[tuple[list[str], np.ndarray]], limit: int | None) -> DataFrame:
    """Best rows per query and partition, or all rows without a limit."""
    shared = vectors.sparkSession.sparkContext.broadcast(groups)

    def best_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), dtype=str)
            _merge(best, shared.value, ids, batch.column(1), batch.num_rows if limit is None else limit)
            if limit is None:
                yield from _best_table(best).to_batches()
                best = {}
        yield from _best_table(best).to_batches()

    return vectors.mapInArrow(best_of_partition, BEST_SCHEMA)


def embed_column(embed: Callable[[str], Sequence[float]]) -> Callable[[Column], Column]:
    """Column function around a user's text embedder; the embedder is called once per row in Arrow batches."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda text: None if text is None else [float(x) for x in embed(text)])

    return run


def label_centroids(vectors: DataFrame, label: str = "label") -> DataFrame:
    """Mean vector and size per label, built position by position so that a large label is pre-aggregated."""
    cells = vectors.select(label, F.posexplode("embedding").alias("at", "x"))
    means = cells.groupBy(label, "at").agg(
        F.avg(F.col("x").cast("double")).alias("mean"), F.count(F.lit(1)).alias("_rows")
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "mean"))), lambda c: c["mean"])
    return means.groupBy(label).agg(ordered.alias("embedding"), F.max("_rows").alias("members"))


def cluster_similarity(vectors: DataFrame, label: str = "label") -> DataFrame:
    """VectorClusters rows: record, its cluster, cosine to the cluster's centroid."""
    centroids = label_centroids(vectors, label).withColumnRenamed("embedding", "centroid")
    joined = join_per_key(vectors, centroids, label, "members", "inner")
    return joined.select(
        "record_id",
        F.col(label).cast("string").alias("cluster_id"),
        cosine_similarity(F.col("embedding"), F.col("centroid")).alias("similarity_score"),
    )
