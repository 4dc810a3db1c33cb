"""The operators over the given tables, with production parameters, and their SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm import conversation_repair, licenses, line_chunks, minhash, mixing, packing, phrases, projected, quality, suffix_dedup, toxicity, vector_file, window_dedup


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/conversations.parquet")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def op1_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_copies(documents(spark, sf))


def op2_quality_network(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return quality.digest(docs, quality.train(docs, labels(spark, sf), quality.not_held_out()))


def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.digest(licenses.license_scan(documents(spark, sf)))


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(documents(spark, sf)))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_chunks.digest(line_chunks.line_dedup(documents(spark, sf)))


def op6_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.taken_words(*mixing.mix_plan(documents(spark, sf)))


def op7_vector_file(spark: SparkSession, sf: str) -> DataFrame:
    return vector_file.exact_top_k(embeddings(spark, sf), F.col("vec_id") % 50 == 0)


def op8_retrieval_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return toxicity.digest(docs, toxicity.train(docs, labels(spark, sf), toxicity.not_held_out()))


def op10_projected_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return projected.nearest(embeddings(spark, sf), F.col("vec_id") % 100 == 0)


def op11_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.phrases(documents(spark, sf))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    talks = conversations(spark, sf)
    rows = conversation_repair.damaged(talks)
    return conversation_repair.digest(talks, rows, conversation_repair.repaired(rows))


def op13_window_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return window_dedup.digest(window_dedup.without_repeats(documents(spark, sf)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_copies": op1_near_copies,
    "op2_quality_network": op2_quality_network,
    "op3_license_scan": op3_license_scan,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_vector_file": op7_vector_file,
    "op8_retrieval_packing": op8_retrieval_packing,
    "op9_toxicity": op9_toxicity,
    "op10_projected_neighbours": op10_projected_neighbours,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_window_dedup": op13_window_dedup,
}

ORACLES: dict[str, str] = {
    "op3_license_scan": licenses.license_sql(),
    "op5_line_dedup": line_chunks.line_sql(),
    "op6_source_mixing": mixing.mix_sql(),
    "op7_vector_file": vector_file.top_k_sql(),
    "op11_phrase_collocations": phrases.phrases_sql(),
    "op13_window_dedup": window_dedup.windows_sql(),
}
