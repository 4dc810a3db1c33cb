"""Approximate nearest neighbours by stable projections in a kd-tree with a chi-square stopping test."""

from __future__ import annotations

from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stackroom.llm.vector_blocks import Best, asked, blocked, met, searched, usable_vectors
from stackroom.plans.order import top_per_key
from stackroom.runtime import materialised

# Projected dimensions (even, for the closed form of the chi-square distribution), seed, and vectors per leaf and block.
DIMENSIONS, SEED, LEAF_ROWS, TREE_ROWS = 8, 17, 32, 8192
# Leaves that are opened at once.
OPENED = 8
# Least probability that a neighbour as near as the kth found would have been met already.
CONFIDENCE = 0.97
# Queries whose products are held at once, and rows per query that are verified at first.
QUERY_ROWS, FIRST_READ = 256, 32
# Components of the differences that are held at once.
READ_CELLS = 1 << 20


def projection(size: int) -> np.ndarray:
    """Normal, hence 2-stable, random directions: squared projected distances are chi-square multiples of true ones."""
    return np.random.default_rng([SEED, size]).normal(size=(size, DIMENSIONS))


def chi_square(x: np.ndarray, freedom: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x) / 2
    return 1 - np.exp(-half) * sum(half**i / factorial(i) for i in range(freedom // 2))


def ring_of(confidence: float) -> float:
    """The least number whose ``chi_square`` reaches the confidence; infinity if none does."""
    low, high = 0.0, 1e4
    if not chi_square(high, DIMENSIONS) >= confidence:
        return float("inf")
    while low < (middle := (low + high) / 2) < high:
        low, high = (low, middle) if chi_square(middle, DIMENSIONS) >= confidence else (middle, high)
    return high


def tree_leaves(points: np.ndarray, leaf_rows: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: medians split the widest side until a node is small."""
    nodes, leaves = [np.arange(len(points))], []
    while nodes:
        node = nodes.pop()
        if len(node) <= leaf_rows:
            leaves.append(node)
            continue
        own = points[node]
        side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        half = len(node) // 2
        order = np.argpartition(own[:, side], half)
        nodes += [node[order[half:]], node[order[:half]]]
    return leaves


def narrow(matrix: np.ndarray) -> bytes:
    """The components as floats if those hold them exactly, else as doubles."""
    with np.errstate(over="ignore"):
        floats = matrix.astype(np.float32)
    return (floats if np.array_equal(floats, matrix) else matrix).tobytes()


def widened(data: bytes, rows: int, size: int) -> np.ndarray:
    return np.frombuffer(data, f"f{len(data) // (rows * size)}").reshape(rows, size).astype(np.float64)


def index_block(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
    """A block of the index: ids and vectors in the order of the leaves, their first rows, and the leaves' boxes."""
    points = matrix @ projection(matrix.shape[1])
    leaves = tree_leaves(points, LEAF_ROWS)
    order = np.concatenate(leaves)
    boxes = np.stack([np.stack([points[leaf].min(axis=0), points[leaf].max(axis=0)]) for leaf in leaves])
    starts = np.cumsum([0, *map(len, leaves)])
    return {"ids": ids[order].astype(np.int64).tobytes(), "data": narrow(matrix[order]), "starts": starts.astype(np.int64).tobytes(), "boxes": boxes.tobytes()}


def encode_queries(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
    return {"ids": ids.astype(np.int64).tobytes(), "data": narrow(matrix)}


def products(data: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Rows and queries whose product is (|q|**2 - distance**2) / 2, the |q|**2, most error of the products, and the scale.

    All are floats of both sides around the rows' mean, scaled by a power of two to components of 1 at most.
    """
    most = max(np.abs(data).max(), np.abs(queries).max())
    mean = (data / len(data)).sum(axis=0)
    x, q = data - mean, queries - mean
    scale = 2.0 ** -np.frexp(max(np.abs(x).max(), np.abs(q).max()))[1]
    x, q = x * scale, q * scale
    x_squares, q_squares = np.einsum("rd,rd->r", x, x), np.einsum("rd,rd->r", q, q)
    longest = np.sqrt(x_squares.max())
    lengths = np.sqrt(q_squares) + longest
    error = lengths * longest * (x.shape[1] + 8) * 2.0**-22 + lengths * most * scale * x.shape[1] * 2.0**-50 + 2.0**-100
    rows = np.concatenate([x, -x_squares[:, None] / 2], axis=1).astype(np.float32)
    asked = np.concatenate([q, np.ones((len(q), 1))], axis=1).astype(np.float32)
    return np.ascontiguousarray(rows.T), asked, q_squares, error, scale


def near_in_block(k: int, confidence: float):
    """The k nearest verified rows per query over blocks.

    Leaves are opened in the order of the projected distance of their boxes, which yields projected neighbours in growing
    rings; their vectors are verified by true distance. With all rows within projected radius r verified, a
    row nearer than the kth found is still unseen with probability at most 1 - chi2(r**2 / d_k**2); the search of
    the block ends when that is small.

    Only rows as near as the kth so far are looked at. They come from products of all rows and queries at once, and a row
    counts if the search would have opened its leaf: if fewer than k rows were near enough to end it before.
    Where the products can't tell, the leaves are opened one after the other.
    """
    ring = ring_of(confidence)

    def opened(ids: np.ndarray, data: np.ndarray, starts: np.ndarray, boxes: np.ndarray, own: int, query: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gaps = np.maximum(np.maximum(boxes[:, 0] - centre, centre - boxes[:, 1]), 0)
        reach = np.einsum("ld,ld->l", gaps, gaps)
        leaves = np.argsort(reach, kind="stable")
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        for first in range(0, len(leaves), OPENED):
            if len(best) == k and (best[-1] == 0 or chi_square(reach[leaves[first]] / best[-1] ** 2, DIMENSIONS) >= confidence):
                # At distance 0 only equal vectors could still enter, and those have projected distance 0.
                if best[-1] > 0 or reach[leaves[first]] > 0:
                    break
            rows = np.concatenate([np.arange(starts[leaf], starts[leaf + 1]) for leaf in leaves[first : first + OPENED]])
            rows = rows[ids[rows] != own]
            difference = data[rows] - query
            all_ids = np.concatenate([best_ids, ids[rows]])
            all_best = np.concatenate([best, np.sqrt(np.einsum("rd,rd->r", difference, difference))])
            order = np.lexsort((all_ids, all_best))[:k]
            best_ids, best = all_ids[order], all_best[order]
        return best_ids, best

    def run(row: dict, best: Best | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = row["size"]
        ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
        best = best or Best(len(query_ids), k, np.float64)
        data, queries = widened(row["data"], len(ids), size), widened(row["q_data"], len(query_ids), size)
        starts = np.frombuffer(row["starts"], np.int64)
        boxes = np.frombuffer(row["boxes"]).reshape(len(starts) - 1, 2, DIMENSIONS)
        centres = queries @ projection(size)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            scanned, asked, squares, error, scale = products(data, queries)
            plain = confidence > 0 and 0 < scale**2 < np.inf and all(np.isfinite(x).all() for x in (boxes, centres, scanned, asked, error))
        last, read = best.last(np.inf), max(FIRST_READ, 2 * k)
        held = np.empty((min(QUERY_ROWS, len(queries)), len(ids)), np.float32)
        leaf_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))

        def one_by_one(i: int) -> None:
            near, distance = opened(ids, data, starts, boxes, query_ids[i], queries[i], centres[i])
            best.add(np.full(len(near), i), near, distance)

        for start in range(0, len(queries), QUERY_ROWS):
            block = slice(start, min(start + QUERY_ROWS, len(queries)))
            if not plain:
                for i in range(block.start, block.stop):
                    one_by_one(i)
                continue
            # Products from ``least`` on are of rows as near as the kth, or may be.
            least = (squares[block] - (last[block] * scale) ** 2) / 2 - error[block]
            least = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
            near = np.matmul(asked[block], scanned, out=held[: len(least)])
            some = np.flatnonzero(near.max(axis=1) >= least)
            # From here on of those queries only.
            near, at, least = near[some], start + some, least[some]
            own_ids, own, centre, square, slack, floor = query_ids[at], queries[at], centres[at], squares[at], error[at], last[at]
            passing = near >= least[:, None]
            counts = np.count_nonzero(passing, axis=1)
            # What lies beyond the rows looked at is farther than this.
            beyond = np.full(len(floor), np.inf)
            many = np.flatnonzero(counts > read)
            if len(many):
                top = np.argpartition(-near[many], read - 1, axis=1)[:, :read]
                passing[many] = False
                passing[many[:, None], top] = True
                edge = np.take_along_axis(near[many], top, 1).min(axis=1).astype(np.float64)
                beyond[many] = np.sqrt(np.maximum(square[many] - 2 * (edge + slack[many]), 0)) / scale
            i, r = np.divmod(np.flatnonzero(passing), len(ids))
            other = ids[r] != own_ids[i]
            i, r = i[other], r[other]
            most, distance = max(1, READ_CELLS // size), np.empty(len(i))
            for a in range(0, len(i), most):
                difference = data[r[a : a + most]] - own[i[a : a + most]]
                distance[a : a + most] = np.sqrt(np.einsum("rd,rd->r", difference, difference))
            # The kth distance of the rows looked at; the others are farther than ``far``.
            order = np.lexsort((distance, i))
            first = np.searchsorted(i, np.arange(len(floor) + 1))
            kth, far = np.full(len(floor), np.inf), np.minimum(floor, beyond)
            enough = np.flatnonzero(np.diff(first) >= k)
            kth[enough] = distance[order[first[enough] + k - 1]]
            ends = np.minimum(kth, far) ** 2
            inside = distance <= floor[i]
            i, r, distance = i[inside], r[inside], distance[inside]
            # A search ends before a leaf only if k rows are so near, for the leaf's reach at most.
            box, c = boxes[leaf_of[r]], centre[i]
            gaps = np.maximum(np.maximum(box[:, 0] - c, c - box[:, 1]), 0)
            sure = np.einsum("pd,pd->p", gaps, gaps) / ring < ends[i]
            unsure = np.flatnonzero(~sure)
            if len(unsure):
                asking, u = np.unique(i[unsure], return_inverse=True)
                gaps = np.maximum(np.maximum(boxes[None, :, 0] - centre[asking][:, None], centre[asking][:, None] - boxes[None, :, 1]), 0)
                reach = np.einsum("uld,uld->ul", gaps, gaps)
                order = np.argsort(reach, axis=1, kind="stable")
                rank = np.empty_like(order)
                np.put_along_axis(rank, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
                turn = rank[u, leaf_of[r[unsure]]] // OPENED
                sure[unsure] = (turn == 0) | (reach[u, order[u, turn * OPENED]] / ring < ends[i[unsure]])
            # A query goes leaf by leaf if that can't be told, or if k rows weren't found among those looked at.
            slow = np.zeros(len(floor), bool)
            slow[i[~sure]] = True
            cut = np.bincount(i[distance < beyond[i]], minlength=len(floor)) < k
            slow[many] |= cut[many]
            for j in at[slow]:
                one_by_one(j)
            fast = ~slow[i]
            best.add(at[i[fast]], ids[r[fast]], distance[fast])
        return best.rows(query_ids)

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """About the k nearest rows by Euclidean distance for every query row: (query_id, rank, vec_id, score).

    Every row is indexed: blocks of vectors are projected to ``DIMENSIONS`` random directions and ordered by a kd-tree. Blocks
    are searched for all queries, and only the k nearest per query and task are shuffled. ``score`` is the true
    distance in double precision; ties go to the smaller id; fewer than k candidates are all returned. The
    chance to miss a neighbour is below 1 - ``confidence`` per neighbour.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null ids. Rows that
    share an id count once, with their smallest vector. Only vectors of equal length meet. An empty table
    gives no rows.
    """
    usable = materialised(usable_vectors(vectors, vec_id, vector, lambda v: F.exists(v, lambda x: x != 0)))
    candidates = blocked(usable, index_block, ["ids", "data", "starts", "boxes"], TREE_ROWS)
    queries = asked(usable.filter(is_query), encode_queries)
    close = searched(met(candidates, queries), near_in_block(k, confidence), k, "double")
    order = [F.col("score"), F.col("vec_id")]
    top = top_per_key(close, ["query_id"], order, k)
    return top.select("query_id", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).alias("rank"), "vec_id", "score")
