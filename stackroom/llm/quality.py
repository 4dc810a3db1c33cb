"""Quality by a byte-level convolutional network in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import bucket_of_id
from stackroom.llm.training import labelled_sample, log_odds, score_rows, sigmoid

# Bytes per chunk, and from one chunk to the next; neighbours overlap by more than a filter.
CHUNK, HOP = 256, 232
# Width of a filter and bytes from one position to the next.
WIDTH, STRIDE = 8, 2
POSITIONS = (CHUNK - WIDTH) // STRIDE + 1
# Numbers per byte, and filters.
SIZE, FILTERS = 4, 16
# Chunks that are convolved at once.
TILE = 128
# Documents that learn from per class, and passes over them.
PER_CLASS, EPOCHS = 1500, 8
# Steps that small samples take at least.
LEAST_STEPS = 700


@dataclass
class Network:
    """Byte vectors, filters, and the combination of the pooled filters; ``shift`` corrects the share of classes."""

    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    top: np.ndarray
    intercept: np.ndarray
    shift: float = 0.0

    @property
    def learned(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.top, self.intercept]


def chunks_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping chunks that cover every byte (padded by zeros), and the number of chunks per text; at least one."""
    data = [t.encode() for t in texts]
    counts = np.array([1 + max(0, -(-(len(d) - CHUNK) // HOP)) for d in data], np.int64)
    rows = []
    for d, n in zip(data, counts):
        padded = np.zeros((n - 1) * HOP + CHUNK, np.uint8)
        padded[: len(d)] = np.frombuffer(d, np.uint8)
        rows.append(sliding_window_view(padded, CHUNK)[::HOP])
    return (np.concatenate(rows) if rows else np.zeros((0, CHUNK), np.uint8)), counts


def _windows(chunks: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    embedded = vectors[chunks].reshape(len(chunks), CHUNK * SIZE)
    return sliding_window_view(embedded, WIDTH * SIZE, axis=1)[:, :: STRIDE * SIZE]


def pooled(net: Network, chunks: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Largest response of every filter in every chunk, and its position if asked for."""
    best = np.empty((len(chunks), FILTERS), np.float32)
    at = np.empty((len(chunks), FILTERS), np.int64) if where else None
    for start in range(0, len(chunks), TILE):
        tile = np.ascontiguousarray(_windows(chunks[start : start + TILE], net.vectors))
        response = (tile.reshape(-1, WIDTH * SIZE) @ net.filters).reshape(len(tile), POSITIONS, FILTERS)
        if where:
            at[start : start + TILE] = response.argmax(axis=1)
        best[start : start + TILE] = response.max(axis=1)
    return np.maximum(best + net.bias, 0), at


def combined(active: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Largest and mean pooled value over the chunks of each text."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.concatenate([np.maximum.reduceat(active, first), np.add.reduceat(active, first) / counts[:, None]], axis=1)


def probabilities(net: Network, texts: list[str]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    chunks, counts = chunks_of(texts)
    joined = combined(pooled(net, chunks)[0], counts)
    return sigmoid((joined @ net.top + net.intercept[0]).astype(np.float64) + net.shift)


def _slopes(net: Network, chunks: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss."""
    active, at = pooled(net, chunks, where=True)
    joined = combined(active, counts)
    error = ((sigmoid(joined @ net.top + net.intercept[0]) - labels) / len(labels)).astype(np.float32)
    text = np.repeat(np.arange(len(counts)), counts)
    back = error[:, None] * net.top[None, :]
    largest = active == joined[text, :FILTERS]
    slope = back[text, :FILTERS] * largest + back[text, FILTERS:] / counts[text][:, None].astype(np.float32)
    slope *= active > 0
    # Only the pooled positions carry a gradient.
    inside = np.arange(WIDTH)[None, None, :] + STRIDE * at[:, :, None]
    window_bytes = chunks[np.arange(len(chunks))[:, None, None], inside]
    windows = net.vectors[window_bytes].reshape(len(chunks), FILTERS, WIDTH * SIZE)
    filters = np.einsum("cf,cfk->kf", slope, windows)
    to_window = slope[:, :, None] * net.filters.T[None, :, :]
    vectors = np.zeros_like(net.vectors)
    parts = to_window.reshape(-1, SIZE)
    for k in range(SIZE):
        vectors[:, k] = np.bincount(window_bytes.ravel(), weights=parts[:, k], minlength=256)
    return [vectors, filters, slope.sum(axis=0), joined.T @ error, np.array([error.sum()], np.float32)]


def fit(texts: list[str], labels: np.ndarray, share: float, epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01, seed: int = 11) -> Network:
    """Train by gradient steps on small batches, in a seeded order; a small sample is passed over more often."""
    epochs = max(epochs, -(-LEAST_STEPS * batch // max(1, len(texts)))) if epochs > 1 else epochs
    random = np.random.default_rng(seed)
    net = Network(
        random.normal(0, 0.5, (256, SIZE)).astype(np.float32),
        random.normal(0, 0.3, (WIDTH * SIZE, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        random.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
        log_odds(share),
    )
    ones = labels.sum()
    if not ones or ones == len(labels):
        net.top[:] = 0
        return net
    net.shift = log_odds(share) - log_odds(ones / len(labels))
    first, second = [np.zeros_like(p) for p in net.learned], [np.zeros_like(p) for p in net.learned]
    data = [chunks_of([t]) for t in texts]
    steps = 0
    total = epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = random.permutation(len(texts))
        for start in range(0, len(texts), batch):
            rows = order[start : start + batch]
            chunks, counts = np.concatenate([data[i][0] for i in rows]), np.concatenate([data[i][1] for i in rows])
            steps += 1
            pace = rate * (1 - steps / (total + 1))
            for p, m, v, g in zip(net.learned, first, second, _slopes(net, chunks, counts, labels[rows])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-8)
    return net


def not_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the id modulo 4 is not 2."""
    return bucket_of_id(doc_id, 4) != 2


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", per_class: int = PER_CLASS) -> Network:
    """Fit on at most ``per_class`` labelled documents of each class; the sample is what the driver holds."""
    return fit(*labelled_sample(docs, labels, label, usable, per_class))


def with_quality(docs: DataFrame, net: Network, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns with the probability of good quality of the whole text in ``name``.

    Row-local and without a shuffle; memory is bounded by a part of a batch, or by one text. Null texts are
    scored as empty ones; repeated rows get equal scores; an empty table gives no rows.
    """
    return score_rows(docs, lambda texts: probabilities(net, texts), text, name)


def digest(docs: DataFrame, net: Network, threshold: float = 0.7) -> DataFrame:
    scored = with_quality(docs.select("doc_id", "text"), net)
    return scored.select(
        "doc_id", F.coalesce(bucket_of_id("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
