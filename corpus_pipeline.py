"""From raw documents to packed training sequences: five stages, each a table that the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm import line_chunks, minhash, mixing, packing, toxicity
from stackroom.plans.order import top_per_key
from stackroom.runtime import materialised

TOXIC_FROM = 0.7
TOKENIZER = "word_bpe_49k.json"


def measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now; null for a null text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of toxicity is below ``TOXIC_FROM``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, toxicity.not_held_out())
    return toxicity.with_toxicity(docs, model, name="__toxicity").filter(F.col("__toxicity") < TOXIC_FROM).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks that stand earlier in the corpus; none is dropped."""
    return measured(line_chunks.cleaned_documents(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies, once; rows without an id stay."""
    kept = minhash.near_copies(docs).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    once = top_per_key(docs.filter(F.col("doc_id").isNotNull()), ["doc_id"], ["text"])
    return once.join(kept, F.col("doc_id") == F.col("__kept"), "left_semi").unionByName(docs.filter(F.col("doc_id").isNull()))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, a row per repetition."""
    _, plan = mixing.mix_plan(docs)
    return measured(mixing.mixed_documents(docs, plan))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# A classifier and a packing are not SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
