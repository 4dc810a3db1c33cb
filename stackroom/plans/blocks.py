"""Window results along a sequence whose key may hold a large share of all rows.

A window over ``key`` alone puts one recording into one task. Here the sequence is cut into blocks of a
bounded number of positions, the window runs inside each block, and one summary row per block carries the
state over the block border. Only keys longer than a block have borders.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.plans.order import row_index

BLOCK_ROWS = 200_000
# Rows per block of a running peak.
PEAK_ROWS = 20_000
EARLIER = (Window.unboundedPreceding, -1)


def _block(order: str, block_rows: int) -> Column:
    return F.floor(F.col(order) / block_rows)


def with_previous(
    df: DataFrame,
    key: str,
    order: str,
    values: Mapping[str, Column],
    name: str = "prev",
    block_rows: int = BLOCK_ROWS,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add the ``values`` as columns, and those of the preceding row of the key as a struct (null on the first).

    ``order`` is a position, unique per key; gaps are allowed. The values at block borders are computed
    for the border rows only; there is at most one border per ``block_rows`` positions, which bounds the
    broadcast. When ``df`` holds the values already, ``source`` is the table to compute them from there.
    """
    source = df if source is None else source
    blocked = df.withColumn("_block", _block(order, block_rows))
    ends = source.groupBy(key, _block(order, block_rows).alias("_block")).agg(F.max(order).alias(order))
    following = F.lead("_block").over(Window.partitionBy(key).orderBy("_block"))
    borders = ends.select(key, order, following.alias("_block")).filter(F.col("_block").isNotNull())
    carry = source.join(F.broadcast(borders), [key, order]).select(
        key, "_block", F.struct(*[v.alias(n) for n, v in values.items()]).alias("_carry")
    )
    inside = Window.partitionBy(key, "_block").orderBy(order)
    missing = {n: v for n, v in values.items() if n not in df.columns}
    local = blocked.withColumns(missing).withColumn("_lag", F.lag(F.struct(*values)).over(inside))
    return (
        local.join(carry, [key, "_block"], "left")
        .withColumn(name, F.coalesce("_lag", "_carry"))
        .drop("_lag", "_carry", "_block")
    )


def with_next(
    df: DataFrame,
    key: str,
    order: str,
    values: Mapping[str, Column],
    name: str = "next",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the ``values`` as columns, and those of the following row of the key as a struct (null on the last)."""
    backward = df.withColumn("_backward", -F.col(order))
    return with_previous(backward, key, "_backward", values, name, block_rows).drop("_backward")


def long_keys(df: DataFrame, key: str, order: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Keys whose positions from 0 fill more than one block: at most one per ``block_rows`` positions."""
    return df.groupBy(key).agg(F.max(order).alias("_last")).filter(F.col("_last") >= block_rows).select(key)


def with_position(
    df: DataFrame, key: str, order: str, name: str, long: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add the 0-based place of the row within its key.

    ``long`` are the :func:`long_keys`; only their blocks are counted.
    """
    blocked = df.withColumn("_block", _block(order, block_rows))
    place = F.row_number().over(Window.partitionBy(key, "_block").orderBy(order)) - 1
    counted = blocked.select(key, "_block").join(F.broadcast(long), key, "left_semi")
    sizes = counted.groupBy(key, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(key).orderBy("_block").rowsBetween(*EARLIER))
    carry = sizes.select(key, "_block", before.alias("_carry")).filter(F.col("_carry").isNotNull())
    return (
        blocked.withColumn("_place", place)
        .join(carry, [key, "_block"], "left")
        .withColumn(name, F.col("_place") + F.coalesce("_carry", F.lit(0)))
        .drop("_place", "_carry", "_block")
    )


def with_peak_before(
    df: DataFrame, key: str, start: str, end: str, name: str, cell_seconds: float | None = None, block_rows: int = PEAK_ROWS
) -> DataFrame:
    """Add the greatest ``end`` among the rows of the key that precede in (start, end) order.

    Rows must be distinct in (key, start, end). Blocks hold as many rows each, however close together the rows of a key
    lie: the peak within a block and the peak of the blocks before it, of which one row each is ordered per key, make up
    the whole. With ``cell_seconds`` blocks are spans of time instead, for rows that are known to be spread over it.
    """
    if cell_seconds is None:
        cells = row_index(df, [key, start, end], "_place").withColumn("_cell", F.floor(F.col("_place") / block_rows)).drop("_place")
    else:
        cells = df.withColumn("_cell", F.floor(F.col(start) / cell_seconds))
    inside = Window.partitionBy(key, "_cell").orderBy(start, end).rowsBetween(*EARLIER)
    peaks = cells.groupBy(key, "_cell").agg(F.max(end).alias("_peak"))
    across = Window.partitionBy(key).orderBy("_cell").rowsBetween(*EARLIER)
    carry = peaks.select(key, "_cell", F.max("_peak").over(across).alias("_carry"))
    return (
        cells.withColumn("_local", F.max(end).over(inside))
        .join(carry, [key, "_cell"], "left")
        .withColumn(name, F.greatest("_local", "_carry"))
        .drop("_local", "_carry", "_cell")
    )
