"""Saved search answers and detail answers as record tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.numbers import let
from stackroom.model import FACETS, RECORD, RECORD_FIELDS

RAW_PAGE = "name STRING, search STRUCT<result_count: BIGINT, results: ARRAY<STRING>, facets: MAP<STRING, MAP<STRING, BIGINT>>>"
QUARANTINE = "missing id or title"


def _page_number(name: Column) -> Column:
    return F.regexp_extract(name, r"(\d+)(?:\.json)?$", 1).try_cast("bigint")


def _raw_pages(spark: SparkSession, path: str | Sequence[str], one_per_file: bool) -> DataFrame:
    """One row per page; results stay JSON text so that unknown keys survive.

    A page is a whole file (``page-000001.json``) or a line with its ``name``.
    """
    raw = spark.read.schema(RAW_PAGE).json(path if isinstance(path, str) else list(path), multiLine=one_per_file)
    return raw.select("name", "search.*", F.col("_metadata.file_path").alias("page_file")).withColumn(
        "page", F.coalesce(_page_number(F.col("name")), _page_number(F.col("page_file")))
    )


def _open_map(raw: Column) -> Column:
    return F.from_json(raw, "map<string,string>")


def split_extra_fields(raw: Column, modelled: Sequence[str] = tuple(RECORD_FIELDS)) -> Column:
    """Keys of a JSON object outside the model, values as JSON text; null when there are none."""
    extra = F.map_filter(_open_map(raw), lambda key, _: ~key.isin(*modelled))
    return let(extra, lambda tail: F.when(F.size(tail) > 0, tail))


def _typed(raw: Column) -> Column:
    """The modelled columns as one struct, so that a record is parsed once."""
    return F.from_json(raw, RECORD)


def _is_text(body: Column, key: str) -> Column:
    """The value of a top-level key of a JSON variant is a string."""
    return F.coalesce(F.schema_of_variant(F.variant_get(body, f"$.{key}", "variant")) == "STRING", F.lit(False))


def read_search_pages(spark: SparkSession, path: str | Sequence[str], one_per_file: bool = True) -> DataFrame:
    """One row per result: page, position in the page, modelled columns and the open tail.

    Rows whose ``id`` or ``title`` is missing or not a string carry a reason in ``rejected``.
    """
    rows = _raw_pages(spark, path, one_per_file).select("page_file", "page", F.posexplode("results").alias("page_pos", "raw"))
    rows = rows.withColumns({"body": F.try_parse_json("raw"), "record": _typed(F.col("raw"))})
    fit = _is_text(F.col("body"), "id") & _is_text(F.col("body"), "title")
    return rows.select(
        "page_file",
        "page",
        F.struct("page", "page_file", "page_pos").alias("pos"),
        "page_pos",
        "record.*",
        split_extra_fields(F.col("raw")).alias("extra_fields"),
        F.when(~fit, F.lit(QUARANTINE)).alias("rejected"),
    )


def read_result_counts(spark: SparkSession, path: str | Sequence[str], one_per_file: bool = True) -> DataFrame:
    return _raw_pages(spark, path, one_per_file).select("page_file", "page", "result_count")


def facet_rows(facets: DataFrame, column: str = "facets") -> DataFrame:
    """``field -> term -> count`` maps as rows; other columns are kept."""
    kept = [c for c in facets.columns if c != column]
    fields = facets.select(*kept, F.explode(F.col(column).cast(FACETS)).alias("field", "_terms"))
    return fields.select(*kept, "field", F.explode("_terms").alias("term", "count"))


def read_facet_map(spark: SparkSession, path: str | Sequence[str], one_per_file: bool = True) -> DataFrame:
    return facet_rows(_raw_pages(spark, path, one_per_file).select("page_file", "page", "facets"))


def read_detail_records(spark: SparkSession, path: str | Sequence[str], one_per_file: bool = True) -> DataFrame:
    """``record`` envelopes; numeric ids become text."""
    raw = spark.read.schema("record STRING").json(path if isinstance(path, str) else list(path), multiLine=one_per_file)
    values = F.col("values")
    typed = raw.withColumns({"values": _open_map(F.col("record")), "typed": _typed(F.col("record"))})
    return typed.select(
        F.trim(values["id"]).alias("id"),
        *[F.col(f"typed.{n}").alias(n) for n in RECORD_FIELDS if n != "id"],
        F.coalesce(
            F.from_json(values["primary_collection"], "array<string>"), F.array(values["primary_collection"])
        ).alias("primary_collection"),
        *[_text_or_list(values[name]).alias(name + "s") for name in ("object_url", "landing_url", "url")],
        F.col("record").alias("raw"),
    )


def _text_or_list(value: Column) -> Column:
    """A JSON string or list of strings as an array; null when absent."""
    return F.when(F.startswith(value, F.lit("[")), F.from_json(value, "array<string>")).when(
        value.isNotNull(), F.array(value)
    )
