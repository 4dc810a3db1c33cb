"""Bounded samples of labelled documents, and scoring of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.minhash import parts_of

# Documents above this length are not learned from (they are scored).
LONGEST = 200_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, doc_id: str = "doc_id", text: str = "text") -> tuple[list[str], np.ndarray, float]:
    """Texts, labels and the share of label 1 among all usable rows.

    At most ``per_class`` ids per label are chosen, in the order of a hash of the id, from rows of ``labels`` that meet
    ``usable``; only these reach the documents (by broadcast of at most twice ``per_class`` ids) and the driver.
    """
    known = labels.filter(usable & F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = None
    for value in (0, 1):
        part = known.filter(F.col("_label") == value).dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(ids), "_id")
    rows = rows.filter(F.length("_text") <= LONGEST).dropDuplicates(["_id", "_label"]).collect()
    rows.sort(key=lambda r: (r["_id"], r["_label"]))
    total = sum(counts.values())
    return [r["_text"] for r in rows], np.array([r["_label"] for r in rows], np.float64), (counts.get(1, 0) / total if total else 0.5)


def score_rows(docs: DataFrame, score: Callable[[list[str]], np.ndarray], text: str, name: str) -> DataFrame:
    """The rows with a score of their whole text in column ``name``; a null text is scored as an empty one."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, at):
                scores = score([t or "" for t in batch.column(at).to_pylist()])
                columns = [*batch.columns, pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    return docs.mapInArrow(run, docs.select("*", F.lit(0.0).alias(name)).schema)


def log_odds(share: float) -> float:
    share = min(max(share, 1e-4), 1 - 1e-4)
    return float(np.log(share / (1 - share)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))
