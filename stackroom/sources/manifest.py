"""Append-only JSONL event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.model import MANIFEST_EVENT
from stackroom.runtime import materialised


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with file, 1-based line number and a global position.

    Splits are read in parallel; a line's place is its place in the split plus the lines of the splits
    before it. Only one row per split (a file block) is ordered in one task. The lines are written once,
    as a second read could cut the files differently.
    """
    lines = materialised(
        spark.read.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_mark"),
        )
    )
    splits = lines.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_lines"), F.min("_mark").alias("_first"))
    earlier = Window.unboundedPreceding, -1
    in_file = Window.partitionBy("file").orderBy("_start").rowsBetween(*earlier)
    overall = Window.orderBy("file", "_start").rowsBetween(*earlier)
    placed = splits.select(
        "file",
        "_start",
        "_first",
        F.coalesce(F.sum("_lines").over(in_file), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_lines").over(overall), F.lit(0)).alias("_offset"),
    )
    place = F.col("_mark") - F.col("_first")
    # One row per split of the log: bounded by its size over spark.sql.files.maxPartitionBytes.
    return lines.join(F.broadcast(placed), ["file", "_start"]).select(
        "file",
        (F.col("_before") + place + 1).alias("line"),
        (F.col("_offset") + place).alias("pos"),
        "value",
    )


def parse_events(lines: DataFrame) -> DataFrame:
    """Typed events per non-blank line; ``malformed`` marks lines that are not exactly one JSON object.

    The line is read as the only element of a list, as a plain read would accept text after an object.
    """
    kept = lines.filter(F.regexp_replace("value", r"(?U)\s+", "") != "")
    as_list = F.concat(F.lit("["), "value", F.lit("]"))
    listed = F.from_json(as_list, T.ArrayType(MANIFEST_EVENT), {"allowSingleQuotes": "false"})
    parsed = kept.withColumn("_events", listed).withColumn("_event", F.get("_events", F.lit(0)))
    single = F.coalesce(F.size("_events") == 1, F.lit(False)) & F.col("_event").isNotNull()
    return parsed.select(
        "file",
        "line",
        "pos",
        *[F.col(f"_event.{name}").alias(name) for name in MANIFEST_EVENT.names],
        F.col("value").alias("raw"),
        (~single).alias("malformed"),
    )


def read_manifest(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """Events in log order. Strict reading fails on a malformed line and names it; otherwise it is flagged."""
    events = parse_events(read_lines(spark, path))
    if not strict:
        return events
    message = F.concat(F.lit("invalid manifest JSON on line "), F.col("line").cast("string"))
    checked = F.when(F.col("malformed"), F.raise_error(message).cast("boolean")).otherwise(F.lit(False))
    return events.withColumn("malformed", checked).filter(~F.col("malformed")).drop("malformed")
