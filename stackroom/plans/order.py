"""First/last rows per key and a distributed row index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.runtime import materialised

# Ranks up to here become a group limit below the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """First ``n`` rows per key.

    The rank filter becomes a group limit below the shuffle, so a hot key sends at most ``n`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Row with the greatest ``order`` per key; partially aggregated before the shuffle."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key).agg(F.max_by(row, F.col(order)).alias("_row")).select("_row.*")


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Row with the smallest ``order`` per key; partially aggregated before the shuffle."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key).agg(F.min_by(row, F.col(order)).alias("_row")).select("_row.*")


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_index") -> DataFrame:
    """Add a 0-based global position in the given order without a single-task window.

    The sort is a range partitioning, so a hot leading value is split by the following sort columns.
    Writing the sorted rows fixes the sampled range bounds; only one row per partition is then ranked.
    """
    marked = materialised(df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mark"), 33)
    sizes = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    # One row per sort partition: bounded by the number of shuffle partitions.
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_mark", "_before")
    )


def ranked_per_key(
    df: DataFrame, key: str, order: Sequence[Column | str], name: str, last: int, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """Rows ranked 1 to ``last`` per key, for the few keys that a request names.

    Small ranks use a group limit. Larger ones come from the distributed row index and one offset per key, as
    a plain rank would sort each key in one task.
    """
    if last <= group_limit:
        rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        return df.withColumn(name, rank).filter(F.col(name) <= last)
    indexed = row_index(df, [key, *order], "_at")
    starts = F.broadcast(indexed.groupBy(key).agg(F.min("_at").alias("_start")))
    rank = (F.col("_at") - F.col("_start") + 1).cast("int")
    return indexed.join(starts, key).withColumn(name, rank).filter(F.col(name) <= last).drop("_at", "_start")
