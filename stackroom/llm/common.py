"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.runtime import materialised

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bucket_of_id(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids fall into no bucket (null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (id, component) per linked id, component its smallest id.

    Each round sends the smaller label over every link and then follows labels of labels, so chains shorten
    by half a round; every round is a table in the shared folder. Only the count of changed labels reaches the
    driver. A hub with many links is a partial minimum in each task, and the joins may be split by key.
    """
    both = materialised(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialised(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("component")))
    while True:
        heard = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("other")), "b")
        low = heard.groupBy(F.col("a").alias("id")).agg(F.min("other").alias("low"))
        nearer = labels.join(low, "id").select("id", F.col("component").alias("old"), F.least("component", "low").alias("near"))
        jump = labels.select(F.col("id").alias("near"), F.col("component").alias("far"))
        stepped = materialised(nearer.join(jump, "near", "left").select("id", "old", F.least("near", F.coalesce("far", "near")).alias("component")))
        labels = stepped.select("id", "component")
        if not stepped.filter(F.col("old") != F.col("component")).limit(1).count():
            return labels
