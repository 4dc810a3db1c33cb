"""Exact join of codes that agree in most positions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions.arrays import positional_similarity
from stackroom.runtime import materialised

BAND_ROWS = 1000
# Fills the places behind the end of a shorter code.
PAD = "\u0001"


def _pieces(rest: Column, count: int) -> Column:
    """Array of (no, part, rest): each piece of the remaining positions and the positions without it."""

    def cut(i: Column) -> Column:
        return F.floor(i * F.length(rest) / count).cast("int")

    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.struct(
            i.alias("no"),
            F.substr(rest, cut(i) + 1, cut(i + 1) - cut(i)).alias("part"),
            F.concat(F.substr(rest, F.lit(1), cut(i)), F.substr(rest, cut(i + 1) + 1, F.length(rest))).alias("rest"),
        ),
    )


def _pairs(banded: DataFrame, code: str) -> DataFrame:
    left = banded.select("path", F.col(code).alias("left_code"))
    right = banded.select("path", F.col(code).alias("right_code"))
    return left.join(right, "path").filter(F.col("left_code") < F.col("right_code")).select("left_code", "right_code")


def similar_codes(
    codes: DataFrame, code: str, length: int, threshold: float, band_rows: int = BAND_ROWS, levels: int = 3
) -> DataFrame:
    """Pairs ``left_code < right_code`` of distinct codes with positional ``score >= threshold``.

    Codes may have any length; ``length`` is the usual one. Shorter codes are filled up to the longest. With one
    band more than mismatches allowed, two similar codes agree on a whole band. A group of more than
    ``band_rows`` codes that share a band is cut again over the remaining positions, where similar codes must
    again agree on one of as many pieces, up to ``levels`` times: codes of a group that no cut divides are alike
    nearly everywhere, and are pairs of the result. The distinct codes are read from the source once.
    """
    distinct = materialised(codes.select(code).filter(F.length(code) > 0).distinct())
    longest = distinct.agg(F.coalesce(F.max(F.length(code)), F.lit(0)).alias("n")).first()["n"]
    width = max(length, longest)
    bands = width - math.ceil((threshold - 5e-7) * width) + 1
    if not 0 < bands <= width:
        raise ValueError(f"threshold {threshold} leaves no common band of codes of length {width}")
    level = distinct.select(code, F.lit("").alias("path"), F.rpad(code, width, PAD).alias("rest"))
    pairs = None
    for below in reversed(range(levels)):
        cut = level.select(code, F.col("path").alias("above"), F.inline(_pieces(F.col("rest"), bands)))
        named = F.concat("above", F.lit("/"), F.col("no").cast("string"), F.lit(":"), "part")
        banded = materialised(cut.select(code, named.alias("path"), "rest"))
        groups = banded.groupBy("path").agg(F.count(F.lit(1)).alias("_codes"), F.max(F.length("rest")).alias("_left"))
        groups = materialised(groups.filter(F.col("_codes") > 1))
        crowded = (F.col("_codes") > band_rows) & (F.col("_left") >= bands) & F.lit(below > 0)
        found = _pairs(banded.join(groups.filter(~crowded), "path", "left_semi"), code)
        pairs = found if pairs is None else pairs.unionByName(found)
        finer = groups.filter(crowded)
        if not below or not finer.limit(1).count():
            break
        level = banded.join(finer, "path", "left_semi")
    score = positional_similarity(F.col("left_code"), F.col("right_code"))
    return pairs.distinct().withColumn("score", score).filter(F.col("score") >= threshold)
