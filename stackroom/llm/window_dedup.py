"""Removal of repeated word windows: a merged count-min sketch finds them, a second pass groups them exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.llm.hashing import mixed, run_hashes
from stackroom.runtime import materialised, materialised_by

# Words of a window, about as many words as a part of the documents has, and words per bucket of repeated windows.
WORDS, PART_WORDS, BUCKET_WORDS = 13, 500_000, 1_000_000
# Rows of the sketch, its slices per row as a power of two, and the most cells of a slice as a power of two.
ROWS, SLICES, SLICE_CELLS = 2, 7, 27
# Words of the runs whose least hash names a window's bucket, and the fewest buckets.
MARK_WORDS, BUCKETS = 3, 64


class Windows:
    """All windows of consecutive words of some texts, whose words are divided by one space each."""

    def __init__(self, texts: list[bytes], words: int):
        self.blob = b"\n".join(texts)
        data = np.frombuffer(self.blob, np.uint8)
        gaps = np.flatnonzero((data == 32) | (data == 10))
        starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
        of_text = np.concatenate([[0], np.cumsum(data[gaps] == 10)]).astype(np.int64)
        # An empty text has one empty word here.
        at = np.flatnonzero((of_text[words - 1 :] == of_text[: len(of_text) - words + 1]) & (ends > starts)[: max(0, len(starts) - words + 1)])
        self.first_word = np.searchsorted(of_text, np.arange(len(texts)))
        self.word, self.text = at, of_text[at]
        self.start, self.end = starts[at], ends[at + words - 1]
        self.hash = run_hashes(data, self.start, self.end) if len(at) else np.zeros(0, np.uint64)
        self._runs = data, starts, ends

    def __getitem__(self, no: int) -> bytes:
        return self.blob[self.start[no] : self.end[no]]

    def marks(self, chosen: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """For each chosen window the place and the hash of its run of words with the least hash, the first of equal ones.

        Equal windows have equal marks, and neighbouring windows mostly have the same one.
        """
        data, starts, ends = self._runs
        size = min(MARK_WORDS, words)
        hashes = run_hashes(data, starts[: len(starts) - size + 1], ends[size - 1 :])
        around = np.lib.stride_tricks.sliding_window_view(hashes, words - size + 1)[self.word[chosen]]
        place = self.word[chosen] + around.argmin(axis=1)
        return place, hashes[place]


class Cells:
    """Shape of the sketch: each of ``ROWS`` rows has 2**bits cells, cut into slices."""

    def __init__(self, windows: int):
        # Four to eight cells per window and row: a few in a hundred single windows share a cell in both rows.
        self.bits = max(10, (4 * windows).bit_length())
        self.slice_bits = min(SLICE_CELLS, max(8, self.bits - SLICES))

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct cells of all rows in order, how often each is met, and the places of the hashes among them by row."""
        rows = [(mixed(hashes ^ mixed(np.array([r], np.uint64))) >> np.uint64(64 - self.bits)) + np.uint64(r << self.bits) for r in range(ROWS)]
        cells, place, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
        return cells.astype(np.int64), counts, place.reshape(ROWS, len(hashes))


def packed_cells(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Steps between cells, each with a bit for a count above one, compressed byte by byte."""
    steps = np.diff(cells * 2 + (counts > 1), prepend=0)
    width = 2 if steps.max() < 1 << 16 else 4
    planes = steps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked_cells(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    width = blob[0]
    planes = np.frombuffer(pa.decompress(blob[1:], n * width, codec="zstd", asbytes=True), np.uint8)
    marks = np.cumsum(planes.reshape(width, n).T.copy().view(f"<u{width}").ravel().astype(np.int64))
    return marks >> 1, (marks & 1) + 1


def _parted(part_words: int):
    """Parts of the documents: their ids, and their words divided by single spaces and line ends, compressed."""
    names = ["part", "ids", "words", "size", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = (context.partitionId() if context else 0) << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            blob = b"\n".join(texts)
            row = [[part], [ids], [held], [len(blob)], [pa.compress(blob, codec="zstd", asbytes=True)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                split = (text.as_py() or b"").split()
                ids.append(name)
                texts.append(b" ".join(split))
                held += len(split)
                if held >= part_words:
                    yield closed()
                    ids, texts, held, part = [], [], 0, part + 1
        if texts:
            yield closed()

    return run


def _texts(blob: bytes, size: int) -> list[bytes]:
    return pa.decompress(blob, size, codec="zstd", asbytes=True).split(b"\n")


def _only(table: pa.Table, name: str):
    """The value of a table with one row."""
    return table.column(name)[0].as_py()


def _sketched(cells: Cells, words: int):
    """The sketch of each part, a row per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, size, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found, counts, _ = cells.of(Windows(_texts(blob.as_py(), size), words).hash)
                slices = found >> cells.slice_bits
                cuts = [0, *(np.flatnonzero(np.diff(slices)) + 1), len(found)] if len(found) else [0]
                own = found - (slices << cells.slice_bits)
                blobs = [packed_cells(own[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:])]
                columns = [pa.array([part] * len(blobs), pa.int64()), pa.array(slices[cuts[:-1]]), pa.array(np.diff(cuts), pa.int64()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "slice", "n", "cells"])

    return run


def _merged(slice_bits: int):
    """The sum of all parts' counts of a slice, and for each part a bit per cell that it met: met again anywhere or not."""

    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << slice_bits, np.uint8)
        sizes, blobs = table.column("n").to_pylist(), table.column("cells")
        for n, blob in zip(sizes, blobs):
            cells, counts = unpacked_cells(blob.as_py(), n)
            # Two is as much as needs to be known.
            total[cells] = np.minimum(total[cells] + counts, 2)
        bits = [np.packbits(total[unpacked_cells(blob.as_py(), n)[0]] > 1).tobytes() for n, blob in zip(sizes, blobs)]
        return pa.table({"part": table.column("part"), "slice": table.column("slice"), "bits": pa.array(bits, pa.binary())})

    return run


def _estimated(cells: Cells, words: int, buckets: int):
    """Runs of a part's windows whose estimate, the least count of their cells, is above one: each run once.

    A run is made of neighbouring windows with the same mark and is sent as one text.
    """

    def run(parts: pa.Table, merged: pa.Table) -> pa.Table:
        ids = np.array([n if n is not None else 0 for n in _only(parts, "ids")], np.int64)
        with_id = np.array([n is not None for n in _only(parts, "ids")], bool)
        windows = Windows(_texts(_only(parts, "texts"), _only(parts, "size")), words)
        found, _, place = cells.of(windows.hash)
        answers = dict(zip(merged.column("_slice").to_pylist(), merged.column("_bits").to_pylist()))
        slices, sizes = np.unique(found >> cells.slice_bits, return_counts=True)
        bits = [np.unpackbits(np.frombuffer(answers[s], np.uint8), count=n) for s, n in zip(slices.tolist(), sizes.tolist())]
        again = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        chosen = np.flatnonzero(again[place].all(axis=0) & with_id[windows.text]) if len(found) else np.zeros(0, np.int64)
        held: dict[bytes, list[int]] = {}
        if len(chosen):
            mark, hashes = windows.marks(chosen, words)
            new = np.ones(len(chosen), bool)
            new[1:] = (np.diff(chosen) != 1) | (np.diff(mark) != 0) | (np.diff(windows.text[chosen]) != 0)
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(chosen)) - 1
            start, end, names = windows.start[chosen[at]], windows.end[chosen[last]], ids[windows.text[chosen[at]]]
            dealt = (hashes[at] % np.uint64(buckets)).astype(np.int64)
            blob = windows.blob
            for a, b, name, no, bucket in zip(start.tolist(), end.tolist(), names.tolist(), chosen[at].tolist(), dealt.tolist()):
                seen = held.setdefault(blob[a:b], [bucket, no, name, name])
                if name < seen[2]:
                    seen[2] = name
                elif name > seen[3]:
                    seen[3] = name
        rows = np.array(list(held.values()), np.int64).reshape(-1, 4)
        part = np.full(len(rows), _only(parts, "part"), np.int64)
        return pa.table({"bucket": rows[:, 0], "part": part, "run": pa.array(held.keys(), pa.binary()), "no": rows[:, 1], "low": rows[:, 2], "high": rows[:, 3]})

    return run


def _windows_of(run: bytes, words: int) -> Iterator[bytes]:
    cuts = [-1, *np.flatnonzero(np.frombuffer(run, np.uint8) == 32).tolist(), len(run)]
    for a, b in zip(cuts, cuts[words:]):
        yield run[a + 1 : b]


def _grouped(words: int):
    """Windows of a bucket grouped by their bytes: for each part those that a smaller id than one of its own has, and that id."""

    def run(table: pa.Table) -> pa.Table:
        first: dict[bytes, int] = {}
        runs, lows = table.column("run"), table.column("low").to_pylist()
        for text, low in zip(runs, lows):
            for window in _windows_of(text.as_py(), words):
                if first.setdefault(window, low) > low:
                    first[window] = low
        nos: dict[int, list[int]] = {}
        firsts: dict[int, list[int]] = {}
        for part, text, no, high in zip(table.column("part").to_pylist(), runs, table.column("no").to_pylist(), table.column("high").to_pylist()):
            for k, window in enumerate(_windows_of(text.as_py(), words)):
                if first[window] < high:
                    nos.setdefault(part, []).append(no + k)
                    firsts.setdefault(part, []).append(first[window])
        lists = pa.list_(pa.int64())
        return pa.table({"part": pa.array(nos.keys(), pa.int64()), "nos": pa.array(nos.values(), lists), "firsts": pa.array(firsts.values(), lists)})

    return run


def _without(words: int):
    """Documents of a part without the words of windows that also start in a document with a smaller id."""

    def run(parts: pa.Table, earlier: pa.Table) -> pa.Table:
        names, texts = _only(parts, "ids"), _texts(_only(parts, "texts"), _only(parts, "size"))
        windows = Windows(texts, words)
        nos = earlier.column("_nos").combine_chunks().flatten().to_numpy().astype(np.int64)
        lows = earlier.column("_firsts").combine_chunks().flatten().to_pylist()
        first = {windows[no]: low for no, low in zip(nos.tolist(), lows)}
        ends = np.append(windows.first_word[1:], windows.blob.count(b" ") + len(texts))
        edges = np.zeros(int(ends[-1]) + 1, np.int64)
        gone = []
        for no in np.flatnonzero(np.isin(windows.hash, windows.hash[nos])).tolist():
            low, name = first.get(windows[no]), names[windows.text[no]]
            if low is not None and name is not None and low < name:
                gone.append(windows.word[no])
        # Windows of one document start at different words.
        edges[gone] += 1
        edges[np.array(gone, np.int64) + words] -= 1
        covered = np.cumsum(edges[:-1]) > 0
        rows = []
        for name, text, a, b in zip(names, texts, windows.first_word, ends):
            own = covered[a:b]
            split = text.split(b" ") if text else []
            borders = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            spans = [{"start": int(s), "end": int(e)} for s, e in zip(borders[::2], borders[1::2])]
            kept = b" ".join([w for w, out in zip(split, own) if not out]) if spans else text
            rows.append((name, kept, len(split), int(own.sum()), spans))
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "kept", "n_words", "n_removed", "removed"])

    return run


def _with(parts: DataFrame, answers: DataFrame, each, schema: str) -> DataFrame:
    """``each`` part with its answers."""
    own = answers.toDF(*[f"_{c}" for c in answers.columns])
    return parts.groupBy("part").cogroup(own.groupBy("_part")).applyInArrow(each, schema)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """Documents without the words of windows that also start in a document with a smaller id.

    Returns doc_id, text (kept words divided by one space), n_words, n_removed and removed, the spans of removed words, one row per
    input row. A window is ``words`` consecutive words of one document; words are divided by ASCII white space. Windows
    are judged on the input, not on what is left, and overlap freely.

    Each part of about ``part_words`` words (or one longer document) makes a count-min sketch that names only the cells it met. Its
    slices are added up in one task each, where all counts of a cell are in one place, and each part learns which of its
    cells are met again. The sketch grows with the number of words, so its estimates stay as sharp on larger
    inputs. No estimate is below the true count; only windows estimated repeated are sent on and grouped by their bytes.
    Neighbouring ones go as one text to the bucket of their mark, once per part, so a passage that stands in a third of all
    documents costs a bucket one text per part.

    Null texts have no words. Documents with a null id keep all words and take none from others, rows that share an id
    don't either from each other. An empty table gives no rows; only the two named columns are read.
    """
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    # Texts meet their answers twice: dealt by part once, they are never shuffled.
    parts = materialised_by(read.mapInArrow(_parted(part_words), "part long, ids array<long>, words long, size long, texts binary"), "part")
    total = parts.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("n")).first()["n"]
    cells, buckets = Cells(total), max(BUCKETS, total // BUCKET_WORDS)
    sketch = parts.select("part", "size", "texts").mapInArrow(_sketched(cells, words), "part long, slice long, n long, cells binary")
    merged = materialised(sketch.groupBy("slice").applyInArrow(_merged(cells.slice_bits), "part long, slice long, bits binary"))
    runs = _with(parts, merged, _estimated(cells, words, buckets), "bucket long, part long, run binary, no long, low long, high long")
    earlier = materialised(runs.groupBy("bucket").applyInArrow(_grouped(words), "part long, nos array<long>, firsts array<long>"))
    left = _with(parts, earlier, _without(words), "doc_id long, kept binary, n_words long, n_removed long, removed array<struct<start long, end long>>")
    return left.select("doc_id", F.col("kept").cast("string").alias("text"), "n_words", "n_removed", "removed")


def digest(cleaned: DataFrame) -> DataFrame:
    """The cleaned documents' counts and the digest of what is left."""
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def windows_sql(words: int = WORDS) -> str:
    return f"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT doc_id, place, array_to_string(words[place : place + {words - 1}], ' ') AS win
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - {words - 2})) AS place FROM split)
        ), firsts AS (
            SELECT win, min(doc_id) AS low FROM windows GROUP BY win HAVING min(doc_id) < max(doc_id)
        ), gone AS (
            SELECT doc_id, list(DISTINCT word) AS places
            FROM (SELECT doc_id, unnest(range(place, place + {words})) AS word FROM windows JOIN firsts USING (win) WHERE low < doc_id)
            GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
            sha256(array_to_string(CASE WHEN places IS NULL THEN words ELSE list_transform(
                list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(places, i)), lambda i: words[i]) END, ' ')) AS kept_sha256
        FROM split LEFT JOIN gone USING (doc_id)
    """
