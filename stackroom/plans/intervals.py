"""Range conditions as equi-joins on cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.plans.order import row_index
from stackroom.runtime import materialised

# Children of a node of the tree over positions, as a power of two.
FAN_BITS = 4


def points_near(points: DataFrame, targets: DataFrame, key: str, at: str, tolerance: float) -> DataFrame:
    """Distinct (key, at) of ``points`` with a target of the key at most ``tolerance`` away.

    Cells are as wide as the tolerance. The lowest and highest target of a cell decide every point in and
    around it, so a crowded cell costs one row and points and targets are never paired. Two cells to each
    side are probed, as the division may round over a cell edge.
    """
    if not tolerance > 0:
        exact = targets.select(key, at).distinct()
        return points.select(key, at).distinct().join(exact, [key, at], "left_semi")
    cell = F.floor(F.col(at) / tolerance)
    edges = targets.groupBy(key, cell.alias("_cell")).agg(F.min(at).alias("_low"), F.max(at).alias("_high"))
    probes = points.select(key, at).distinct().withColumn("_cell", F.explode(F.sequence(cell - 2, cell + 2)))
    near = (F.abs(F.col(at) - F.col("_low")) <= tolerance) | (F.abs(F.col(at) - F.col("_high")) <= tolerance)
    return probes.join(edges, [key, "_cell"]).filter(near).select(key, at).distinct()


def first_in_spans(
    spans: DataFrame, points: DataFrame, key: str, span: str, start: str, end: str, at: str, value: str,
    cell: float = 300.0,
) -> DataFrame:
    """Smallest ``value`` among the points of the key with ``start <= at < end``, per (key, span, start).

    ``spans`` has finite or null (open) ends. Points are pre-aggregated per position, so repeated
    positions and long recordings stay spread over (key, cell).
    """
    lowest = points.groupBy(key, at).agg(F.min(value).alias(value)).withColumn("_cell", F.floor(F.col(at) / cell))
    edge = points.groupBy(key).agg(F.max(at).alias("_edge"))
    first = F.floor(F.col(start) / cell)
    last = F.floor(F.least(F.coalesce(F.col(end), F.col("_edge")), F.col("_edge")) / cell)
    cells = (
        spans.select(key, span, start, end)
        .join(edge, key)
        .filter((first <= last) & (F.col(end).isNull() | (F.col(end) > F.col(start))))
        .withColumn("_cell", F.explode(F.sequence(first, last)))
    )
    inside = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    return cells.join(lowest, [key, "_cell"]).filter(inside).groupBy(key, span, start).agg(F.min(value).alias(value))


def _nodes(levels: int, low: str, high: str) -> str:
    """SQL for the nodes (level, node) that together cover the positions from ``low`` to before ``high``."""

    def first(level: str) -> str:
        return f"shiftright({low} + shiftleft(1L, {FAN_BITS} * ({level})) - 1, {FAN_BITS} * ({level}))"

    def behind(level: str) -> str:
        return f"shiftright({high}, {FAN_BITS} * ({level}))"

    def run(a: str, b: str) -> str:
        return f"if({a} < {b}, sequence({a}, {b} - 1), cast(array() as array<bigint>))"

    inner = f"{first('v + 1')} < {behind('v + 1')}"
    left = run(first("v"), f"shiftleft({first('v + 1')}, {FAN_BITS})")
    right = run(f"shiftleft({behind('v + 1')}, {FAN_BITS})", behind("v"))
    here = f"if({inner}, concat({left}, {right}), {run(first('v'), behind('v'))})"
    return f"flatten(transform(sequence(0, {levels - 1}), v -> transform({here}, n -> struct(v as level, n as node))))"


def least_in_spans(
    spans: DataFrame, points: DataFrame, key: str, span: str, start: str, end: str, at: str, value: str
) -> DataFrame:
    """Smallest ``value`` among the points of the key with ``start <= at < end``, per (key, span, start).

    ``spans`` may overlap, nest and lie in any order; a null end is open. Starts, ends and points are put into one
    order over all keys, so a span is a range of positions there. A tree over the positions holds the least value
    below each node; a range is made up of a few nodes per level, however many points lie in it. Nothing is paired
    with the points of a span, and a key's share of the rows does not matter.
    """
    named = spans.filter(F.col(start).isNotNull()).select(key, F.col(span).alias("_span"), F.col(start).alias("_start"), F.col(end).alias("_end")).distinct()
    named = materialised(named.withColumn("_no", F.monotonically_increasing_id()))
    none = F.lit(None)
    last = F.lit(float("inf"))
    kind = points.schema[value].dataType
    lows = named.select(key, F.col("_start").cast("double").alias("_at"), F.lit(0).alias("_kind"), "_no", none.cast(kind).alias("_value"))
    highs = named.select(key, F.coalesce(F.col("_end").cast("double"), last).alias("_at"), F.lit(1).alias("_kind"), "_no", none.cast(kind).alias("_value"))
    inside = points.filter(F.col(at).isNotNull()).select(key, F.col(at).cast("double").alias("_at"), F.lit(2).alias("_kind"), none.cast("long").alias("_no"), F.col(value).alias("_value"))
    # A point at a start lies behind its mark and so inside, one at an end behind its mark and so outside.
    placed = materialised(row_index(lows.unionByName(highs).unionByName(inside), [key, "_at", "_kind"], "_place"))
    rows = placed.count()
    levels = max(1, -(-rows.bit_length() // FAN_BITS))
    low, high = F.max(F.when(F.col("_kind") == 0, F.col("_place"))), F.max(F.when(F.col("_kind") == 1, F.col("_place")))
    ranges = placed.filter("_kind < 2").groupBy("_no").agg((low + 1).alias("_low"), high.alias("_high")).filter("_low < _high")
    covering = ranges.select("_no", F.explode(F.expr(_nodes(levels, "_low", "_high"))).alias("_node")).select("_no", "_node.*")
    tree = placed.filter("_kind = 2").select("_value", "_place", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    tree = tree.groupBy("level", F.expr(f"shiftright(_place, {FAN_BITS} * level)").alias("node")).agg(F.min("_value").alias("_value"))
    found = covering.join(tree, ["level", "node"]).groupBy("_no").agg(F.min("_value").alias("_value"))
    whole = named.join(found, "_no").groupBy(key, "_span", "_start").agg(F.min("_value").alias(value))
    return whole.withColumnsRenamed({"_span": span, "_start": start})
