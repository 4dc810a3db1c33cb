"""Packing whole documents into sequences of neighbours found by a sharded BM25 index."""

from __future__ import annotations

import os
import re
import string
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.llm.minhash import parts_of
from stackroom.runtime import materialised

# Tokens of a full sequence, the id that ends a document, and its first number of bits per stored id.
LENGTH, END = 2048, 1
# Fixed values of BM25, and the share of a shard's documents from which a term's weights are kept as a whole row.
K1, B, DENSE = 1.2, 0.75, 0.25
# Tokens of one index shard and of one partition.
SHARD_TOKENS, PART_TOKENS = 1_000_000, 4_000_000
# Words whose ids a Python worker remembers, new ones that are encoded in one run, and characters of texts split together.
REMEMBERED, PLAIN_RUN, PART_CHARS = 500_000, 4096, 4_000_000
# Letters that are their own normal form, marks that may stand behind them, and what ends the last token of a word.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
PLAIN = rf"^(?P<letters>{LETTERS.pattern})(?P<marks>[{re.escape(string.punctuation)}]*)$"
WORD_END = "</w>"
# Name under which a Python worker keeps its tokenizer.
HELD = "_stackroom_tokens"


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that the rows name, in order."""
    size = sizes[rows]
    after = np.cumsum(size)
    return flat[np.arange(size.sum()) + np.repeat(starts[rows] - (after - size), size)]


class Tokens:
    """Ids of whole texts by way of a memory of words.

    The tokenizer drops white space before it splits and merges nothing across it, so a text's ids are those of
    its parts between spaces and line ends in order. Likewise letters and the marks behind them are split before
    any merge. Most words are such letters, which need no normal form but lower case: letters and marks are told apart by
    Arrow and remembered by themselves. New letters are encoded in one run without the regular expressions, and cut
    where an id ends a word. All else takes the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        """Remember new words: letters in lower case, and others."""
        letters, others = [], []
        for word in words:
            (letters if word.isalpha() and word.islower() and (word.isascii() or LETTERS.fullmatch(word)) else others).append(word)
        flats, sizes = [self.flat], [self.sizes]
        for start in range(0, len(letters), PLAIN_RUN):
            flat = np.array(self.plain.encode(" ".join(letters[start : start + PLAIN_RUN]), add_special_tokens=False).ids, np.uint32)
            flats.append(flat)
            sizes.append(np.diff(np.flatnonzero(self.ends_word[flat]) + 1, prepend=0))
        if others:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
            flats.append(np.array([i for one in ids for i in one], np.uint32))
            sizes.append(np.array(list(map(len, ids)), np.int64))
        self.known.update(zip(letters + others, range(len(self.known), len(self.known) + len(words))))
        self.flat, self.sizes = np.concatenate(flats), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _rows(self, words: pa.Array) -> np.ndarray:
        """Row of each word in the memory."""
        coded = words.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in names if w not in self.known]
        if new:
            self.learn(new)
        return np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy()]

    def of(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """Ids of each text and ``end``; words are told apart by Arrow, so that Python sees the letters of a part once."""
        if len(self.known) > REMEMBERED:
            self.clear()
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        parted = pc.extract_regex(coded.dictionary, PLAIN)
        letters = pc.if_else(parted.is_valid(), pc.utf8_lower(pc.struct_field(parted, "letters")), coded.dictionary)
        rows = np.stack([self._rows(letters), self._rows(pc.fill_null(pc.struct_field(parted, "marks"), ""))], axis=1)
        # The ids of each word of the part, then those of its texts.
        flat, sizes = _gathered(self.flat, self.starts, self.sizes, rows.ravel()), self.sizes[rows].sum(axis=1)
        place = coded.indices.to_numpy()
        ids, after = _gathered(flat, np.cumsum(sizes) - sizes, sizes, place), np.concatenate([[0], np.cumsum(sizes[place])])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return [np.append(ids[a:b], np.uint32(end)) for a, b in zip(after[offsets[:-1]], after[offsets[1:]])]


def tokens_at(path: str) -> Tokens:
    """The tokenizer of a file with its memory, kept by the Python worker for its next tasks.

    Functions that travel with the job have new globals in each task, so the worker's own list of modules holds it.
    """
    held = sys.modules.setdefault(HELD, ModuleType(HELD)).__dict__
    key = path, os.stat(path).st_mtime_ns
    if held.get("key") != key:
        held.update(key=key, tokens=Tokens(path))
    return held["tokens"]


def forget_tokens() -> None:
    """Give back the worker's tokenizer with its memory and what Arrow has freed: its next tasks are of other steps."""
    sys.modules.pop(HELD, None)
    pa.default_memory_pool().release_unused()


def tokenized(docs: DataFrame, doc_id: str, text: str, path: str, end: int = END) -> DataFrame:
    """A table (doc_id, n, ids) with 32-bit ids, each document ended by ``end``; a null text has only that id."""

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = tokens_at(path).of(pc.fill_null(batch.column(1), ""), end)
        blobs = pa.array([x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in ids], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), blobs], ["doc_id", "n", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, 1, PART_CHARS):
                yield encoded(batch)
        pa.default_memory_pool().release_unused()

    return materialised(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "doc_id long, n long, ids binary"))


def ids_of(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<u2" if len(blob) == 2 * n else "<u4").astype(np.uint32)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task per id; all texts have their ids by now, so the worker needs its tokenizer no more."""
    forget_tokens()
    counts, place = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = ids_of(blob, n)
            if (top := int(ids.max())) >= len(counts):
                counts = np.concatenate([counts, np.zeros(top + 1 - len(counts), np.int64)])
                place = np.zeros(len(counts), np.int64)
            # One occurrence of each id: the one that was written last.
            at = np.arange(n)
            place[ids] = at
            counts[ids[place[ids] == at]] += 1
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held], pa.int64())], ["id", "n"])


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """Documents per token id over all documents; as many numbers as the vocabulary has ids reach the driver."""
    rows = tokens.select("n", "ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


@dataclass
class Piece:
    """Tokens start .. start + size of a document of the buffer."""

    doc: int
    start: int
    size: int


class Index:
    """Inverted index of a shard's remainders: postings per term with their BM25 weights."""

    def __init__(self, remainders: list[np.ndarray], idf: np.ndarray, mean_length: float):
        lengths = np.array([len(r) for r in remainders])
        doc = np.repeat(np.arange(len(remainders)), lengths)
        keys, counts = np.unique(doc << 32 | np.concatenate(remainders).astype(np.int64), return_counts=True)
        doc, term = keys >> 32, keys & 0xFFFFFFFF
        weight = idf[term] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[doc] / mean_length))
        # Terms of each document, for it as a seed.
        self.first = np.searchsorted(doc, np.arange(len(remainders) + 1))
        order = np.argsort(term, kind="stable")
        self.posting, self.posting_weight = doc[order], weight[order]
        listed, self.terms = np.unique(term, return_inverse=True)
        self.holders = np.bincount(self.terms, minlength=len(listed))
        self.term_first = np.cumsum(self.holders) - self.holders
        # Frequent terms have a row of weights, at most 1 / DENSE numbers per posting.
        frequent = np.flatnonzero(self.holders >= DENSE * len(remainders))
        self.row = np.full(len(listed), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), len(remainders)))
        held = self.row[self.terms] >= 0
        self.rows[self.row[self.terms[held]], doc[held]] = weight[held]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every document for all terms of the seed."""
        terms = self.terms[self.first[seed] : self.first[seed + 1]]
        rows = self.row[terms]
        terms, rows = terms[rows < 0], rows[rows >= 0]
        sizes = self.holders[terms]
        at = np.arange(sizes.sum()) + np.repeat(self.term_first[terms] - (np.cumsum(sizes) - sizes), sizes)
        found = np.bincount(self.posting[at], self.posting_weight[at], minlength=self.rows.shape[1]).astype(np.float64)
        for row in rows:
            found += self.rows[row]
        return found

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first, ties in shard order."""
        scores = self.scores(seed)
        found = np.flatnonzero((scores > 0) & unused)
        return found[np.argsort(-scores[found], kind="stable")]


def fill(pool: list[Piece], ids: list[np.ndarray], idf: np.ndarray, mean_length: float, length: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of seeds and their neighbours, and what is left when less than a window remains.

    A seed takes the best unused neighbours that fit; the first that doesn't is cut to fill the window, and its rest
    stays unused. Without neighbours the next document in order is taken.
    """
    if not pool:
        return [], []
    index = Index([ids[p.doc][p.start : p.start + p.size] for p in pool], idf, mean_length)
    sizes, starts = np.array([p.size for p in pool]), np.array([p.start for p in pool])
    unused = np.ones(len(pool), bool)
    left, seed, windows = int(sizes.sum()), 0, []

    def take(at: int, size: int) -> Piece:
        piece = Piece(pool[at].doc, int(starts[at]), size)
        starts[at] += size
        sizes[at] -= size
        unused[at] = sizes[at] > 0
        return piece

    while left >= length:
        while not unused[seed]:
            seed += 1
        room = length - int(sizes[seed])
        window = [take(seed, int(sizes[seed]))]
        waiting = index.neighbours(seed, unused)
        while room and len(waiting):
            # The longest run of best neighbours that fits, then the next ones that still fit.
            fits = int(np.searchsorted(np.cumsum(sizes[waiting]), room, side="right"))
            for at in waiting[:fits]:
                room -= int(sizes[at])
                window.append(take(at, int(sizes[at])))
            waiting = waiting[fits:]
            small = sizes[waiting] <= room
            if not small.any():
                break
            cut_next, waiting = waiting[:1], waiting[small]
            waiting = np.concatenate([waiting, cut_next])
        rest = seed
        while room:
            if len(waiting):
                at, waiting = int(waiting[0]), waiting[1:]
            else:
                while not unused[rest]:
                    rest += 1
                at = rest
            size = min(room, int(sizes[at]))
            if size:
                room -= size
                window.append(take(at, size))
        left -= length
        windows.append(window)
    return windows, [Piece(pool[i].doc, int(starts[i]), int(sizes[i])) for i in np.flatnonzero(unused)]


def tail(pieces: list[Piece]) -> list[list[Piece]]:
    """The last tokens in sequences of powers of two, largest first: these need no padding."""
    total, out = sum(p.size for p in pieces), []
    waiting = list(reversed(pieces))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        window = []
        while room:
            piece = waiting.pop()
            size = min(room, piece.size)
            window.append(Piece(piece.doc, piece.start, size))
            room -= size
            if size < piece.size:
                waiting.append(Piece(piece.doc, piece.start + size, piece.size - size))
        out.append(window)
    return out


def _pack(idf: np.ndarray, mean_length: float, length: int):
    schema = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        pool: list[Piece] = []
        held = 0

        def written(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for window in windows:
                offset = 0
                for p in window:
                    tokens = ids[p.doc][p.start : p.start + p.size].astype("<u4")
                    rows.append((names[p.doc], p.start, p.size, zlib.crc32(tokens.tobytes()), len(ids[p.doc]), sequence, offset))
                    offset += p.size
                sequence += 1
            columns = list(zip(*rows)) if rows else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema)

        def shard() -> pa.RecordBatch:
            nonlocal names, ids, pool, held
            windows, pool = fill(pool, ids, idf, mean_length, length)
            out = written(windows)
            # What is left over goes to the next shard.
            kept = sorted({p.doc for p in pool})
            place = {doc: i for i, doc in enumerate(kept)}
            names, ids = [names[d] for d in kept], [ids[d] for d in kept]
            pool = [Piece(place[p.doc], p.start, p.size) for p in pool]
            held = sum(p.size for p in pool)
            return out

        for batch in batches:
            for name, n, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names.append(name)
                ids.append(ids_of(blob, n))
                doc, whole = len(ids) - 1, n // length
                if whole:
                    yield written([[Piece(doc, k * length, length)] for k in range(whole)])
                if n % length:
                    pool.append(Piece(doc, whole * length, n % length))
                held += n
                if held >= SHARD_TOKENS:
                    yield shard()
        yield shard()
        yield written(tail(pool))

    return run


def packed(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` names the tokenizer's file. Each document's ids, ended by ``end``, lie in exactly one piece each. Long
    documents fill sequences of their own; their remainders and all shorter documents are indexed in shards
    of about ``SHARD_TOKENS`` tokens, whose BM25 weights use the document frequencies of all documents. Every sequence
    is full but the last ones of a partition, which have a power of two of tokens, so none needs padding.

    Documents are spread over partitions by a hash of their id and ordered by it, so reruns agree. A shard is closed
    by its size, whatever ids occur, so memory is bounded by a shard and one document. A null text has only the ending id;
    null ids are returned as they are; each of the rows that share an id is packed; an empty table gives no rows.
    """
    tokens = tokenized(docs, doc_id, text, path, end)
    total = tokens.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    seen = document_frequencies(tokens)
    idf = np.log(1 + (total["docs"] - seen + 0.5) / (seen + 0.5))
    parts = max(1, -(-total["tokens"] // PART_TOKENS))
    spread = tokens.withColumn("_h", F.xxhash64("doc_id")).repartition(parts, "_h").sortWithinPartitions("_h", "doc_id", "ids")
    mean_length = min(length, total["tokens"] / max(1, total["docs"]))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return spread.select("doc_id", "n", "ids").mapInArrow(_pack(idf, mean_length, length), schema)
