"""CSV exports, page bodies and binary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.dates import year_from_digits
from stackroom.model import COLLECTIONS_EXPORT, STAR_SCHEMAS, USAGE_EXPORT


def _csv(spark: SparkSession, path: str, schema: str, line_breaks: bool = True) -> DataFrame:
    """``line_breaks`` allows quoted line breaks at the price of unsplittable files."""
    return spark.read.csv(path, schema=schema, header=True, encoding="UTF-8", quote='"', escape='"', multiLine=line_breaks)


def read_star_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A star-schema table from CSV with promoted header and declared types."""
    return _csv(spark, path, STAR_SCHEMAS[table])


def read_undated_records(spark: SparkSession, path: str) -> DataFrame:
    """Records CSV without a year column; the year is taken from the digits of the date."""
    schema = STAR_SCHEMAS["records"].replace("year BIGINT, ", "")
    return _csv(spark, path, schema).withColumn("year", year_from_digits(F.col("date")))


def read_usage_export(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, USAGE_EXPORT, line_breaks=False)


def read_collections_export(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, COLLECTIONS_EXPORT, line_breaks=False)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored page bodies; the whole body is kept."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def file_checksum(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SHA-256, length and path per file (files below 2 GB)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return files.load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def checksum_lines(files: DataFrame) -> DataFrame:
    """``digest  name`` lines in path order."""
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return files.select("path", F.concat_ws("  ", "sha256", name).alias("line")).orderBy("path")
