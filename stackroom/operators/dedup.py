"""Duplicates by title, id, content hash and activity fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.fixed_values import SIMILARITY_THRESHOLD
from stackroom.functions.text import title_key
from stackroom.plans.bands import similar_codes
from stackroom.plans.order import top_per_key
from stackroom.plans.skew import join_per_key
from stackroom.runtime import materialised


def dedup_by_title(df: DataFrame, title: str = "title", pos: str = "pos") -> DataFrame:
    """First record per normalised title; records without a title are dropped."""
    keyed = df.withColumn("_key", title_key(F.col(title))).filter(F.col("_key") != "")
    return top_per_key(keyed, ["_key"], [pos]).drop("_key")


def dedup_by_id(df: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    return top_per_key(df, [key], [pos])


def exact_duplicates(
    processed: DataFrame, content: str = "normalized_sha256", record: str = "record_id", pos: str = "pos"
) -> DataFrame:
    """Add ``duplicate_of``: the record of the earliest prior row with equal content and another record.

    The first two records per content decide every row, so nothing is windowed over a content group. The rows
    are written once, as several steps read them: a digest in ``content`` is computed once per row.
    """
    processed = materialised(processed)
    sightings = processed.filter(F.col(content).isNotNull()).groupBy(content, record).agg(
        F.min(pos).alias("_seen"), F.count(F.lit(1)).alias("_rows")
    )
    sizes = sightings.groupBy(content).agg(F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_records"))
    firsts = top_per_key(sightings, [content], ["_seen"], 2).groupBy(content).agg(
        F.min_by(record, "_seen").alias("_first"),
        F.max_by(record, "_seen").alias("_second"),
        F.max("_seen").alias("_second_pos"),
    )
    shared = sizes.filter(F.col("_records") > 1).join(firsts, content).drop("_records")
    joined = join_per_key(processed, shared, content, "_rows")
    earlier = F.when(F.col(record) != F.col("_first"), F.col("_first")).when(
        F.col(pos) > F.col("_second_pos"), F.col("_second")
    )
    return joined.withColumn("duplicate_of", earlier).drop("_first", "_second", "_second_pos")


def fingerprint_groups(
    items: DataFrame, code: str = "fingerprint", record: str = "record_id", pos: str = "pos"
) -> DataFrame:
    """One row per distinct fingerprint: records, first position and first record."""
    return items.groupBy(code).agg(
        F.count(F.lit(1)).alias("records"), F.min(pos).alias("first_pos"), F.min_by(record, pos).alias("first_record")
    )


def similar_fingerprints(
    items: DataFrame, code: str = "fingerprint", threshold: float = SIMILARITY_THRESHOLD, length: int = 64
) -> DataFrame:
    """Pairs of distinct fingerprints at or above the threshold, in both directions, and each with itself.

    Together with the item table this is the whole candidate relation in factored form: an item's
    candidates are the earlier items of other records that carry a ``similar`` fingerprint.
    """
    pairs = similar_codes(items, code, length, threshold)
    there = pairs.select(F.col("left_code").alias(code), F.col("right_code").alias("similar"), "score")
    back = pairs.select(F.col("right_code").alias(code), F.col("left_code").alias("similar"), "score")
    same = items.select(code).filter(F.length(code) > 0).distinct().select(
        F.col(code), F.col(code).alias("similar"), F.lit(1.0).alias("score")
    )
    return there.unionByName(back).unionByName(same)


def similarity_candidates(
    items: DataFrame, code: str = "fingerprint", record: str = "record_id", pos: str = "pos",
    threshold: float = SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Per item (latest processed row of a record): the earliest similar item before it, and the review flag.

    Only the first record of each similar group matters: if it precedes the item, the item has a
    candidate. Identical copies are never paired with each other. The items are written once, as they
    are a log state that several steps read.
    """
    items = materialised(items)
    groups = fingerprint_groups(items, code, record, pos)
    heads = groups.select(F.col(code).alias("similar"), "first_pos", "first_record")
    earliest = (
        similar_fingerprints(items, code, threshold)
        .join(heads, "similar")
        .groupBy(code)
        .agg(
            F.min("first_pos").alias("_pos"),
            F.min_by(F.struct("first_record", "score"), "first_pos").alias("_head"),
        )
        .join(groups.select(code, F.col("records").alias("_rows")), code)
    )
    found = F.col("_pos") < F.col(pos)
    return (
        join_per_key(items, earliest, code, "_rows")
        .withColumn("first_candidate", F.when(found, F.col("_head.first_record")))
        .withColumn("score", F.when(found, F.col("_head.score")))
        .withColumn("review_required", F.coalesce(found, F.lit(False)))
        .drop("_pos", "_head")
    )


def media_candidates(*sources: Column) -> Column:
    """Distinct https URLs of the given URL lists, in order."""
    empty = F.array().cast("array<string>")
    urls = F.concat(*[F.coalesce(s, empty) for s in sources])
    return F.array_distinct(F.filter(urls, lambda u: F.startswith(u, F.lit("https://"))))


def distinct_entities(entities: DataFrame, keys: Sequence[str] = ("recording_id", "text", "start")) -> DataFrame:
    return entities.dropDuplicates(list(keys))
