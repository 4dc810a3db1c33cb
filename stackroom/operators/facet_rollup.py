"""Facet counts kept as signed differences: additions, replacements and removals without a count over all records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.operators.facets import record_terms
from stackroom.plans.levels import GENERATION, LeveledTables
from stackroom.plans.order import top_per_key
from stackroom.runtime import materialised

TERMS = "array<struct<field string, term string>>"
HELD = f"number long, terms {TERMS}"
COUNTS = "field string, term string, n long"
TRIES = 100


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("field", "term").agg(F.sum("n").alias("n")).filter(F.col("n") != 0)


def _of_field(field: str, terms: Column) -> Column:
    return F.transform(terms, lambda t: F.struct(F.lit(field).alias("field"), t.alias("term")))


def _newest(held: DataFrame) -> DataFrame:
    return held.groupBy("number").agg(F.max_by("terms", GENERATION).alias("terms"))


def _merged(tables: Mapping[str, DataFrame], oldest: bool) -> Mapping[str, DataFrame]:
    held = _newest(tables["held"])
    # Null terms stand for a removed record, which older folders may still hold.
    return {"held": held.filter(F.col("terms").isNotNull()) if oldest else held, "counts": _summed(tables["counts"].drop(GENERATION))}


class FacetRollup:
    """Counts per field and term of numbered records in a folder, together with the terms that each record counts for.

    A change reads the earlier terms of the changed records only and adds the differences; a reader sums the
    differences, of which merges of levels keep one per term and folder. Changes that meet are made one after the other.
    """

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[str]):
        self.fields = list(fields)
        self.tables = LeveledTables(spark, path, _merged).create(held=HELD, counts=COUNTS)

    def add(self, records: DataFrame, number: str = "pos") -> None:
        """Count records, or count them anew with their new terms. Of rows with one number the first in the order of terms counts."""
        per_field = [_of_field(f, record_terms(records, f)) for f in self.fields]
        empty = F.array().cast(TERMS)
        terms = F.array_sort(F.concat(empty, *[F.coalesce(p, empty) for p in per_field]))
        rows = records.select(F.col(number).cast("long").alias("number"), terms.alias("terms")).filter(F.col("number").isNotNull())
        self._change(top_per_key(rows, ["number"], ["terms"]))

    def remove(self, records: DataFrame, number: str = "pos") -> None:
        """Count records no longer."""
        rows = records.select(F.col(number).cast("long").alias("number")).filter(F.col("number").isNotNull()).distinct()
        self._change(rows.withColumn("terms", F.lit(None).cast(TERMS)))

    def _change(self, rows: DataFrame) -> None:
        rows = materialised(rows)

        def counted(held: DataFrame, sign: int) -> DataFrame:
            return held.select(F.inline("terms")).withColumn("n", F.lit(sign).cast("long"))

        for _ in range(TRIES):
            after = self.tables.last_generation()
            earlier = _newest(self.tables.read("held").join(rows.select("number"), "number", "left_semi"))
            differences = _summed(counted(rows, 1).unionByName(counted(earlier, -1)))
            if self.tables.add(after=after, held=rows, counts=differences):
                return
        raise RuntimeError(f"other writers came first {TRIES} times")

    def counts(self) -> DataFrame:
        """Records per (field, term)."""
        return _summed(self.tables.rows("counts")).withColumnRenamed("n", "count")

    def compact(self) -> None:
        self.tables.compact()
