"""Star-schema measures over Records, Citations, VectorClusters and the year dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.dates import decade


def dim_date(spark: SparkSession) -> DataFrame:
    """Years 1800 to 2030 with their decade."""
    return spark.range(1800, 2031).select(F.col("id").alias("Year"), decade(F.col("id")).alias("Decade"))


def distinct_with_blank(value: str) -> Column:
    """Distinct values, a blank counting as one value."""
    return F.count_distinct(F.col(value)) + F.coalesce(F.max(F.col(value).isNull().cast("int")), F.lit(0))


def total_records(records: DataFrame) -> DataFrame:
    return records.agg(F.count(F.lit(1)).alias("total_records"))


def records_with_dates(records: DataFrame) -> DataFrame:
    return records.agg(F.count_if(F.col("year").isNotNull()).alias("records_with_dates"))


def unique_citations(citations: DataFrame) -> DataFrame:
    return citations.agg(distinct_with_blank("citation_key").alias("unique_citations"))


def citation_coverage(records: DataFrame, citations: DataFrame) -> DataFrame:
    """Unique citations per record; blank without records."""
    unique = unique_citations(citations).scalar()
    return total_records(records).select(F.try_divide(unique, F.col("total_records")).alias("citation_coverage"))


def distinct_partners(records: DataFrame) -> DataFrame:
    """Distinct values of the joined partner text."""
    return records.agg(distinct_with_blank("content_partner").alias("distinct_partners"))


def distinct_categories(records: DataFrame) -> DataFrame:
    return records.agg(distinct_with_blank("category").alias("distinct_categories"))


def _by_year(records: DataFrame) -> DataFrame:
    """Record counts per matched dimension row; years outside the dimension fall to the blank row."""
    counts = records.groupBy("year").agg(F.count(F.lit(1)).alias("records"))
    dim = dim_date(records.sparkSession)
    return counts.join(F.broadcast(dim), counts["year"] == dim["Year"], "left").select(
        dim["Year"].alias("dim_year"), "Decade", "records"
    )


def records_per_year(records: DataFrame) -> DataFrame:
    return _by_year(records).groupBy("dim_year").agg(F.sum("records").alias("records"))


def records_per_decade(records: DataFrame) -> DataFrame:
    return _by_year(records).groupBy(F.col("Decade").alias("decade")).agg(F.sum("records").alias("records"))


def cluster_count(clusters: DataFrame) -> DataFrame:
    return clusters.agg(distinct_with_blank("cluster_id").alias("cluster_count"))


def average_similarity(clusters: DataFrame, *slicers: str) -> DataFrame:
    return clusters.groupBy(*slicers).agg(F.avg("similarity_score").alias("average_similarity"))
