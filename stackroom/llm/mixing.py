"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stackroom.llm.common import whole_text
from stackroom.plans.order import row_index
from stackroom.runtime import materialised

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
# Hex digits of a document's place that name its bucket.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def place(doc_id: str, seed: int) -> Column:
    """Seeded place of a document in its source's order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    """Water-filling over (source, source_size): adds weight and target.

    Sources get the level times their weight, or ``epochs`` times their size where that is less. Each round finds
    the level from the sums of capped sizes and free weights, until no further source is capped; only these
    sums reach the driver, so the number of sources is free.
    """
    ordered = row_index(sources, [F.col("source").isNull(), F.col("source")], "_rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    cap = (F.col("source_size") * F.lit(epochs)).cast("double")
    rated = materialised(ordered.withColumn("weight", F.get(cycle, (F.col("_rank") % len(weights)).cast("int"))).withColumn("_cap", cap).drop("_rank"))
    wanted = float(rated.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words")).first()["words"]) * share
    level = 0.0
    while True:
        free = F.col("weight") * F.lit(level) <= F.col("_cap")
        sums = rated.agg(F.sum(F.when(~free, F.col("_cap"))).alias("capped"), F.sum(F.when(free, F.col("weight"))).alias("free")).first()
        if not sums["free"]:
            break
        risen = (wanted - (sums["capped"] or 0.0)) / sums["free"]
        if risen <= level:
            break
        level = risen
    return rated.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("_cap"))).drop("_cap")


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """Sizes of all documents, and per source its target and how much of each document the mix takes.

    Every document is repeated ``whole`` times. The fractional repetition takes the documents whose seeded place is
    below ``cut`` in full and ``part`` words of those at ``cut``, so a source's words meet its rounded target; no document is taken
    more than ``epochs`` times. The second table has one row per source: source, source_size, weight, target,
    whole, cut, part.

    Places are summed in buckets of the seeded order, so that a source of any share is never ordered in one task;
    only the one bucket that holds the cut is. Null sources form a source of their own, last in order; a null
    text has no words; rows that share an id are taken alike; empty tables give empty ones.
    """
    sized = materialised(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(whole_text(text)).alias("size"), place(doc_id, seed).alias("place"))
    )
    bucketed = sized.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = materialised(bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goals = materialised(
        targets.withColumn("whole", whole).withColumn("need", F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("source_size"))
    ).select("source", "source_size", "weight", "target", "whole", "need")

    def running(keys: list[str], order: str) -> Column:
        return F.sum("words").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")

    reached = sums.withColumn("before", running(["source"], "bucket"))
    needs = goals.select(F.col("source").alias("_source"), "need")
    same = F.col("source").eqNullSafe(F.col("_source"))
    cut_bucket = reached.join(needs, same).filter((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("words")))
    cut_bucket = cut_bucket.select("_source", F.col("bucket").alias("_bucket"), (F.col("need") - F.col("before")).alias("left"))
    near = bucketed.join(cut_bucket, same & (F.col("bucket") == F.col("_bucket"))).groupBy("source", "place", "left").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    near = near.withColumn("before", running(["source"], "place"))
    cuts = near.filter((F.col("before") < F.col("left")) & (F.col("left") <= F.col("before") + F.col("words"))).select(
        F.col("source").alias("_source"), F.col("place").alias("cut"), F.floor((F.col("left") - F.col("before")) / F.col("rows")).cast("long").alias("part")
    )
    plan = goals.join(cuts, same, "left").select(
        "source", "source_size", "weight", "target", "whole", F.coalesce("cut", F.lit("")).alias("cut"), F.coalesce("part", F.lit(0)).cast("long").alias("part")
    )
    return sized, materialised(plan)


def fraction(size: Column, at: Column, cut: Column, part: Column) -> Column:
    """Words of a document in the fractional repetition."""
    return F.when(at < cut, size).when(at == cut, F.least(size, part)).otherwise(F.lit(0)).cast("long")


def taken_words(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Words that the mix takes of every document, repetitions counted."""
    per_source = plan.withColumnRenamed("source", "_source")
    joined = sized.join(per_source, F.col("source").eqNullSafe(F.col("_source")))
    partly = fraction(F.col("size"), F.col("place"), F.col("cut"), F.col("part"))
    return joined.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("whole") * F.col("size") + partly).alias("taken"))


def mixed_documents(docs: DataFrame, plan: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """The mixed documents themselves: a row per repetition, the cut document's last one shortened to its words.

    Columns are those of the input. The test is local to a row but for the one row per source.
    """
    per_source = plan.select(F.col("source").alias("__mix_source"), F.struct("whole", "cut", "part").alias("__mix"))
    at, cut, part = place(doc_id, seed), F.col("__mix.cut"), F.col("__mix.part")
    first_words = F.array_join(F.slice(F.filter(F.split(whole_text(text), BLANKS), lambda w: w != ""), F.lit(1), part.cast("int")), " ")
    last = F.when(at < cut, F.array(F.col(text))).when((at == cut) & (part > 0), F.array(F.when(part < word_count(whole_text(text)), first_words).otherwise(F.col(text))))
    copies = F.concat(F.array_repeat(F.col(text), F.col("__mix.whole").cast("int")), F.coalesce(last, F.array().cast("array<string>")))
    joined = docs.join(per_source, F.col(source).eqNullSafe(F.col("__mix_source")))
    return joined.withColumn("__mix_text", F.explode(copies)).withColumn(text, F.col("__mix_text")).select(*docs.columns)


def mix_sql(seed: int = 7) -> str:
    """The mix of ``documents`` with the default parameters in DuckDB SQL."""
    return rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] :: DOUBLE AS weight
  FROM d GROUP BY source
), o AS (SELECT *, 2.0 :: DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0 :: DOUBLE * source_size / weight, source) AS k FROM s),
c AS (
  SELECT *, ((SELECT sum(source_size) FROM s) :: DOUBLE * 1.5 :: DOUBLE - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o
), f AS (SELECT level FROM c WHERE weight * level <= cap ORDER BY k LIMIT 1),
g AS (SELECT source, source_size, least(weight * (SELECT level FROM f), cap) AS target FROM o),
n AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM g),
m AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) - whole * source_size AS need FROM n),
r AS (SELECT d.*, source_size, target, whole, need, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
      FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, size, source_size, round(target, 6) AS target, whole * size + greatest(0, least(size, need - before)) AS taken FROM r"""
