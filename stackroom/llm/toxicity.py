"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import bucket_of_id
from stackroom.llm.training import labelled_sample, log_odds, score_rows, sigmoid

# Lengths of the n-grams, and bits of their hash.
ORDERS = (3, 4, 5, 6)
BITS = 22
# Multipliers of the rolling character hash and of its last step.
ROLL = 0x9E3779B97F4A7C15
LAST = 0xD6E8FEB86659FD93
# Least deviation of an n-gram's class counts from chance, in standard deviations.
LEAST_Z = 4.0
# Texts whose n-grams are held at once while learning.
PART_TEXTS = 50
# Documents that learn from per class.
PER_CLASS = 2000


@dataclass(frozen=True)
class Ngrams:
    """Chosen n-gram buckets in order with their weights, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def ngram_hits(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs of the n-grams of lower-case texts.

    Everything but letters and digits is one space, so n-grams see where words begin and end. With ``wanted``, a flag per
    bucket, only those are returned.
    """
    # Ends of texts are zero characters, whose n-grams occur in every text.
    joined = "\0 " + " \0 ".join(t.replace("\0", " ") for t in texts) + " \0"
    chars = np.frombuffer(joined.lower().encode("utf-32-le"), np.uint32)
    plain = (chars >= 128) | ((chars >= 97) & (chars <= 122)) | ((chars >= 48) & (chars <= 57)) | (chars == 0)
    chars = np.where(plain, chars, np.uint32(32))
    space = chars == 32
    chars = chars[~(space & np.concatenate([[False], space[:-1]]))].astype(np.uint64)
    ends = np.flatnonzero(chars == 0)
    rolled, found = chars, []
    for n in range(2, max(ORDERS) + 1):
        rolled = rolled[:-1] * np.uint64(ROLL) + chars[n - 1 :]
        if n in ORDERS:
            bucket = ((rolled ^ (rolled >> np.uint64(29))) * np.uint64(LAST) >> np.uint64(64 - BITS)).astype(np.int64)
            at = np.arange(len(bucket)) if wanted is None else np.flatnonzero(wanted[bucket])
            text = np.minimum(np.searchsorted(ends, at, side="right") - 1, len(texts) - 1)
            found.append(np.unique(np.maximum(text, 0) << BITS | bucket[at]))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def fit(texts: list[str], labels: np.ndarray, share: float, penalty: float = 1.0, steps: int = 200) -> Ngrams:
    """Log-count ratios of the n-grams that differ between classes, then logistic regression on the scaled presence.

    The intercept is moved from the sample's share of label 1 to the share among all usable rows.
    """
    prior = log_odds(share)
    positive, negative = labels.sum(), len(labels) - labels.sum()
    if not positive or not negative:
        return Ngrams(np.zeros(0, np.int64), np.zeros(0), prior)
    # One pass counts documents per n-gram and class, a second lists the chosen n-grams: memory is that of a part.
    parts = [slice(start, start + PART_TEXTS) for start in range(0, len(texts), PART_TEXTS)]
    with_one, held = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for part in parts:
        row, bucket = ngram_hits(texts[part])
        held += np.bincount(bucket, minlength=1 << BITS)
        with_one += np.bincount(bucket, weights=labels[part][row], minlength=1 << BITS)
    expected = held * positive / (positive + negative)
    z = (with_one - expected) / np.sqrt(expected * negative / (positive + negative) + 0.25)
    wanted = np.abs(z) >= LEAST_Z
    chosen = np.flatnonzero(wanted)
    in_one, in_zero = with_one[chosen] + 1.0, (held - with_one)[chosen] + 1.0
    ratio = np.log((in_one / (positive + 1.0)) / (in_zero / (negative + 1.0)))
    hits = [(row + part.start, np.searchsorted(chosen, bucket)) for part in parts for row, bucket in [ngram_hits(texts[part], wanted)]]
    row, column = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
    weight, intercept = np.zeros(len(chosen)), log_odds(positive / len(labels))
    first, second, moves = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1), 0.05
    for step in range(1, steps + 1):
        margin = intercept + np.bincount(row, weights=(weight * ratio)[column], minlength=len(labels))
        error = (sigmoid(margin) - labels) / len(labels)
        slope = np.append(ratio * np.bincount(column, weights=error[row], minlength=len(chosen)) + penalty * weight / len(labels), error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = moves * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weight, intercept = weight - move[:-1], intercept - move[-1]
    return Ngrams(chosen, weight * ratio, intercept + prior - log_odds(positive / len(labels)))


def scorer(model: Ngrams):
    """A function from texts to probabilities; its table of wanted buckets is made once per worker."""
    made: list[np.ndarray] = []

    def score(texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        if not made:
            flags = np.zeros(1 << BITS, bool)
            flags[model.buckets] = True
            made.append(flags)
        row, bucket = ngram_hits(texts, made[0])
        sums = np.bincount(row, weights=model.weights[np.searchsorted(model.buckets, bucket)], minlength=len(texts))
        return sigmoid(model.intercept + sums)

    return score


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", per_class: int = PER_CLASS) -> Ngrams:
    """Fit on at most ``per_class`` labelled documents of each class; the sample is what the driver holds."""
    return fit(*labelled_sample(docs, labels, label, usable, per_class))


def not_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the id modulo 3 is not 1."""
    return bucket_of_id(doc_id, 3) != 1


def with_toxicity(docs: DataFrame, model: Ngrams, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns with the probability that the whole text is toxic in ``name``.

    Row-local and without a shuffle. Null texts are scored as empty ones, which get the intercept; repeated rows get
    equal scores; an empty table gives no rows.
    """
    return score_rows(docs, scorer(model), text, name)


def digest(docs: DataFrame, model: Ngrams, threshold: float = 0.7) -> DataFrame:
    scored = with_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(bucket_of_id("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
