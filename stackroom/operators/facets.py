"""Facet counts, density plans and count reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.fixed_values import (
    FACET_PAGE_SIZE,
    HARVEST_YEARS,
    MAX_FACET_PAGE_SIZE,
    MAX_PAGE_SIZE,
    PERMITTED_USAGES,
    REPORT_ROWS,
)
from stackroom.plans.order import ranked_per_key, top_per_key


def record_terms(df: DataFrame, name: str) -> Column:
    """Distinct non-null terms of a record's field as an array of text."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.array_distinct(F.array_compact(F.col(name).cast("array<string>")))
    return F.array_compact(F.array(F.col(name).cast("string")))


def facet_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Records per (field, term), all fields in one pass over the data."""
    if not fields:
        return df.sparkSession.createDataFrame([], "field string, term string, count bigint")
    per_field = F.array(*[F.struct(F.lit(f).alias("field"), record_terms(df, f).alias("terms")) for f in fields])
    return (
        df.select(F.inline(per_field))
        .select("field", F.explode("terms").alias("term"))
        .groupBy("field", "term")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def facet_page(counts: DataFrame, page: int = 1, per_page: int = FACET_PAGE_SIZE) -> DataFrame:
    """One page of terms per field, most frequent first."""
    if page < 1 or not 0 <= per_page <= MAX_FACET_PAGE_SIZE:
        raise ValueError(f"facet page starts at 1 and holds 0 to {MAX_FACET_PAGE_SIZE} terms")
    ranked = ranked_per_key(counts, "field", [F.desc("count"), F.col("term")], "rank", page * per_page)
    return ranked.filter(F.col("rank") > (page - 1) * per_page)


def year_density(df: DataFrame, name: str = "year", limit: int | None = HARVEST_YEARS) -> DataFrame:
    """Records per year term in year-text order: the ``limit`` most frequent terms, or all of them for None."""
    counts = facet_counts(df, [name]).select(F.col("term").alias("year"), "count")
    if limit is not None:
        counts = counts.orderBy(F.desc("count"), "year").limit(limit)
    return counts.orderBy("year")


def partition_plan(density: DataFrame, page_size: int = MAX_PAGE_SIZE) -> DataFrame:
    return density.withColumn("pages", F.ceil(F.col("count") / page_size).cast("bigint"))


def deep_harvest(
    df: DataFrame, key: str = "id", pos: str = "pos", name: str = "year", years: int | None = None
) -> DataFrame:
    """All records of the planned years, first record per id in year-then-position order.

    All years are planned, or the ``years`` most frequent ones. Records without a planned year are not returned, as
    each year is fetched on its own.
    """
    hits = df.withColumn("harvest_year", F.explode(record_terms(df, name)))
    if years is not None:
        # At most ``years`` rows, which the caller bounds.
        planned = year_density(df, name, years).select(F.col("year").alias("harvest_year"))
        hits = hits.join(F.broadcast(planned), "harvest_year")
    else:
        hits = hits.filter(F.col("harvest_year").isNotNull())
    return top_per_key(hits, [key], ["harvest_year", pos])


def rights_summary(df: DataFrame) -> DataFrame:
    """Records per (partner, collection, usage) with the total of the collection's rows."""
    partner = F.explode(record_terms(df, "content_partner")).alias("content_partner")
    counts = (
        df.select(partner, "primary_collection", "usage")
        .groupBy("content_partner", "primary_collection", "usage")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    whole = Window.partitionBy("content_partner", "primary_collection")
    return counts.withColumn("usage_total", F.sum("count").over(whole))


def usage_inventory(usage_rows: DataFrame, limit: int = REPORT_ROWS) -> DataFrame:
    """Permitted usage rows with the largest counts."""
    allowed = usage_rows.filter(F.col("usage").isin(*PERMITTED_USAGES))
    ties = ["content_partner", "primary_collection", "usage"]
    return allowed.orderBy(F.desc("count"), F.desc("items_total"), *ties).limit(limit)


def collections_by_count(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc(F.col("count").cast("bigint")), "value")
