"""Removal of long byte strings that occur in an earlier document."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import whole_text
from stackroom.llm.hashing import mixed
from stackroom.llm.suffix_array import common_prefixes, merge_runs, present, suffix_array
from stackroom.runtime import materialised, scratch_path

# Length of the strings, and of the grams whose least one marks each string.
STRING, GRAM = 50, 20
WINDOW = STRING - GRAM + 1
# Bytes of a document shard, of a suffix array's text, and of keys or contexts that meet in one bucket.
SHARD_BYTES, ARRAY_BYTES, BUCKET_BYTES = 6_000_000, 2_000_000, 4_000_000
# Marks that occur more often than this, or hold a larger share of all marks, are dealt by their strings.
HOT, HOT_SHARE = 2000, 50_000
# Bits of a mark's key beyond those that number all marks: one key in 2**16 is taken for another one, which costs a
# context but decides nothing.
SPARE_BITS = 16
# Positions whose marks are found at once.
SLICE = 1 << 16
# Odd multipliers of the hashes.
GRAM_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position; ``data`` has as many bytes to spare at its end."""
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    a, b, c = (np.uint64(k) for k in GRAM_KEYS[:3])
    if isinstance(at, slice):
        parts = word[at], word[at.start + 8 : at.stop + 8], word[at.start + 12 : at.stop + 12]
    else:
        parts = word[at], word[at + 8], word[at + 12]
    h = parts[0] * a + (parts[1] ^ (parts[1] >> np.uint64(31))) * b + (parts[2] ^ (parts[2] >> np.uint64(29))) * c
    return (h ^ (h >> np.uint64(32))) * np.uint64(GRAM_KEYS[3])


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """Best of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = best(x[:-step], x[step:])
        done += step
    return x


def mark_gaps(data: np.ndarray) -> np.ndarray:
    """Distances between marks: positions whose gram has the least hash of some window, hence at least one in every string."""
    n = len(data)
    padded = np.concatenate([np.zeros(WINDOW, np.uint8), data, np.zeros(SLICE + 4 * STRING, np.uint8)])
    found = []
    for start in range(0, n, SLICE):
        # Hashes of the windows that hold these positions.
        hashes = gram_hashes(padded, slice(start, start + SLICE + 2 * WINDOW))
        least = _slide(hashes, WINDOW, np.minimum)
        reached = _slide(least, WINDOW, np.maximum)
        here = hashes[WINDOW - 1 : WINDOW - 1 + len(reached)]
        at = np.flatnonzero(here == reached) + start - 1
        found.append(at[(at >= start) & (at < min(start + SLICE, n))])
    marks = np.concatenate(found) if found else np.zeros(0, np.int64)
    return np.diff(marks, prepend=0).astype(np.uint16)


@dataclass
class Shard:
    """Documents one after another, and their marks with the strings that each one stands for."""

    ids: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    marks: np.ndarray
    low: np.ndarray
    high: np.ndarray
    key: np.ndarray
    doc: np.ndarray


def opened(row: dict, bits: int) -> Shard:
    """A shard with its marks, their keys cut to ``bits``; a mark stands for the strings low..high in whose first window it is the leftmost least one."""
    ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=int(sizes.sum()) + 1), np.uint8)
    ends = np.cumsum(sizes)
    marks = np.cumsum(np.frombuffer(row["gaps"], np.uint16), dtype=np.int64)
    padded = np.concatenate([data, np.zeros(2 * STRING, np.uint8)])
    value = gram_hashes(padded, marks)
    low, high = np.maximum(marks - WINDOW + 1, 0), marks.copy()
    # The nearest mark to the left that is as small ends the reach, and so does the nearest smaller one to the right.
    # Only marks that are not stopped yet and have a further neighbour in reach go on.
    from_left, from_right = np.arange(len(marks)), np.arange(len(marks))
    for step in range(1, WINDOW):
        from_left = from_left[from_left >= step]
        from_left = from_left[marks[from_left - step] >= low[from_left]]
        stop = value[from_left - step] <= value[from_left]
        low[from_left[stop]] = marks[from_left[stop] - step] + 1
        from_left = from_left[~stop]
        from_right = from_right[from_right + step < len(marks)]
        from_right = from_right[marks[from_right + step] - WINDOW < high[from_right]]
        stop = value[from_right + step] < value[from_right]
        high[from_right[stop]] = marks[from_right[stop] + step] - WINDOW
        from_right = from_right[~stop]
        if not len(from_left) and not len(from_right):
            break
    doc = np.searchsorted(ends, marks, side="right")
    doc = np.minimum(doc, max(len(ids) - 1, 0))
    first = (ends - sizes)[doc] if len(ids) else doc
    low, high = np.maximum(low, first), np.minimum(high, ends[doc] - STRING if len(ids) else high)
    held = low <= high
    marks, low, high, doc = marks[held], low[held], high[held], doc[held]
    return Shard(ids, ends, data, marks, low, high, mixed(value[held]) >> np.uint64(64 - bits), doc)


def bucket_cuts(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where sorted keys pass from bucket to bucket: equal ranges of the key space."""
    bounds = [min(b * (1 << bits) // buckets, (1 << bits) - 1) for b in range(buckets)]
    return np.append(np.searchsorted(keys, np.array(bounds, np.uint64)), len(keys))


def key_runs(shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.unique(shard.key, return_counts=True)
    return keys, np.minimum(counts, 255).astype(np.uint8)


@dataclass
class Contexts:
    """Distinct contexts of a shard: bytes start .. start + strings + 49, in the order of their keys."""

    key: np.ndarray
    start: np.ndarray
    strings: np.ndarray
    # Place of the mark in the context.
    mark: np.ndarray
    least_id: np.ndarray
    # For every occurrence its context, first string and document.
    of: np.ndarray
    low: np.ndarray
    count: np.ndarray
    doc: np.ndarray


def context_hashes(data: np.ndarray, start: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the bytes of each context, eight bytes at a time; ``data`` has eight bytes to spare."""
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    size = strings + STRING - 1
    keys = [np.uint64(k) for k in GRAM_KEYS]
    first, second = size.astype(np.uint64) * keys[2], size.astype(np.uint64) * keys[3]
    for place in range(0, int(size.max(initial=0)), 8):
        left = np.clip(size - place, 0, 8)
        at = word[np.minimum(start + place, len(word) - 1)]
        mask = np.where(left == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (8 * np.minimum(left, 7)).astype(np.uint64)) - np.uint64(1))
        part = at & mask
        first = (first ^ part) * keys[0]
        first ^= first >> np.uint64(29)
        second = (second + part) * keys[1]
        second ^= second >> np.uint64(32)
    return mixed(first), mixed(second)


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, start of a group in that order) of rows with equal keys, the first key first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return order, new


def packed_keys(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Differences of sorted keys, byte by byte, and counts, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    raw = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes() + counts.tobytes()
    return np.int64(len(keys)).tobytes() + zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:], max_output_size=9 * n + 1), np.uint8)
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), raw[8 * n :]


def contexts(shard: Shard, keys: np.ndarray, counts: np.ndarray, shared: np.ndarray, hot: np.ndarray, bits: int) -> Contexts:
    """Contexts of the marks that occur elsewhere too; those of hot marks are cut into single strings.

    ``shared`` and ``hot`` are flags of the shard's distinct keys in order. A context's key is its mark's, or its string's.
    """
    at = np.searchsorted(keys, shard.key)
    wanted = (shared | (counts > 1))[at]
    burst = hot[at] & wanted
    whole = wanted & ~burst
    sizes = (shard.high - shard.low + 1)[burst]
    single = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(shard.low[burst], sizes)
    low = np.concatenate([shard.low[whole], single])
    count = np.concatenate([(shard.high - shard.low + 1)[whole], np.ones(len(single), np.int64)])
    mark = np.concatenate([shard.marks[whole], np.repeat(shard.marks[burst], sizes)]) - low
    doc = np.concatenate([shard.doc[whole], np.repeat(shard.doc[burst], sizes)])
    if not len(low):
        none = np.zeros(0, np.int64)
        return Contexts(np.zeros(0, np.uint64), none, none, none, none, none, none, none, none)
    first, second = context_hashes(np.concatenate([shard.data, np.zeros(16, np.uint8)]), low, count)
    key = np.concatenate([shard.key[whole], first[whole.sum() :] >> np.uint64(64 - bits)])
    names = shard.ids[doc]
    order, new = grouped(key, first, second)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    lead = order[new]
    return Contexts(key[lead], low[lead], count[lead], mark[lead], np.minimum.reduceat(names[order], np.flatnonzero(new)), of, low, count, doc)


def decided(strings: np.ndarray, marks: np.ndarray, ids: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For contexts from all shards, one after another in ``data``, a bit per string: does a document with a smaller id hold it?

    Equal contexts hold equal strings, so all but the first document's lose them all. A mark with one distinct context
    is decided by that, as other marks stand for other strings. What is left, one copy of each context of a contested
    mark, goes to the suffix arrays.
    """
    sizes = strings + STRING - 1
    start = np.cumsum(sizes) - sizes
    padded = np.concatenate([data, np.zeros(2 * STRING, np.uint8)])
    first, second = context_hashes(padded, start, strings)
    gram = gram_hashes(padded, start + marks)
    order, new = grouped(gram, first, second)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    lead = order[new]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    _, mark_of, contexts_of_mark = np.unique(gram[lead], return_inverse=True, return_counts=True)
    longest = np.zeros(len(contexts_of_mark), np.int64)
    np.maximum.at(longest, mark_of, strings[lead])
    contested = np.flatnonzero((contexts_of_mark > 1)[mark_of] & (longest > 1)[mark_of])
    bits = np.zeros(len(lead), np.uint32)
    texts = [data[a:b] for a, b in zip(start[lead[contested]], (start + sizes)[lead[contested]])]
    bits[contested] = earliest(texts, strings[lead[contested]], least[contested])
    return np.where(ids > least[of], np.uint32(0xFFFFFFFF), bits[of])


def earliest(texts: list[np.ndarray], strings: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For distinct contexts, a bit per string: does a document with a smaller id hold it?

    Suffix arrays are built per part of ``ARRAY_BYTES``; neighbours with a common prefix of a whole string are one group. Each
    part gives a sorted run of distinct strings with their smallest ids, and the runs are merged by binary search.
    """
    parts, runs = [], []
    sizes = np.array([len(t) for t in texts])
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // ARRAY_BYTES, prepend=0))
    for a, b in zip([0, *cuts], [*cuts, len(texts)]):
        if a == b:
            continue
        data = np.concatenate(texts[a:b])
        first = np.cumsum(sizes[a:b]) - sizes[a:b]
        context = np.repeat(np.arange(a, b), strings[a:b])
        inside = np.arange(len(context)) - np.repeat(np.cumsum(strings[a:b]) - strings[a:b], strings[a:b])
        owner = np.full(len(data), -1)
        owner[np.repeat(first, strings[a:b]) + inside] = np.arange(len(context))
        order = suffix_array(data, STRING)
        prefix = common_prefixes(data, order, STRING)
        # Suffixes in the last bytes of a context are no strings; a chain of prefixes may pass through them.
        group = np.cumsum(prefix < STRING)
        chosen = owner[order] >= 0
        order, group = order[chosen], group[chosen]
        new = np.ones(len(order), bool)
        new[1:] = group[1:] != group[:-1]
        lead = np.flatnonzero(new)
        place = owner[order]
        least = np.minimum.reduceat(ids[context[place]], lead)
        found = sliding_window_view(data, STRING)[order[lead]]
        run = np.ascontiguousarray(found).view(f"S{STRING}").ravel()
        number = np.empty(len(context), np.int64)
        number[place] = np.cumsum(new) - 1
        runs.append((run, least))
        parts.append((context, inside, number, run))
    flags = np.zeros(len(texts), np.uint32)
    if not runs:
        return flags
    every, least = merge_runs(runs, np.minimum)
    for context, inside, number, run in parts:
        smaller = least[present(every, run)][number] < ids[context]
        np.bitwise_or.at(flags, context[smaller], np.uint32(1) << inside[smaller].astype(np.uint32))
    return flags


def packed_contexts(shard: Shard, c: Contexts, a: int, b: int) -> bytes:
    sizes = c.strings[a:b] + STRING - 1
    at = np.repeat(c.start[a:b] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    heads = c.strings[a:b].astype(np.uint8).tobytes() + c.mark[a:b].astype(np.uint8).tobytes() + c.least_id[a:b].astype(np.int64).tobytes()
    blob = heads + shard.data[at].tobytes()
    return np.int64(b - a).tobytes() + np.int64(len(blob)).tobytes() + zstandard.ZstdCompressor(level=3).compress(blob)


def unpacked_contexts(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, size = (int(x) for x in np.frombuffer(blob[:16], np.int64))
    raw = zstandard.ZstdDecompressor().decompress(blob[16:], max_output_size=size + 1)
    strings, marks = np.frombuffer(raw[:n], np.uint8).astype(np.int64), np.frombuffer(raw[n : 2 * n], np.uint8).astype(np.int64)
    return strings, marks, np.frombuffer(raw[2 * n : 10 * n], np.int64), np.frombuffer(raw[10 * n :], np.uint8)


def row_batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


SHARDS = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary()), ("gaps", pa.binary())])
RUNS = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("run", pa.binary())])


def _make_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    ids: list[int] = []
    texts: list[bytes] = []

    def out() -> pa.RecordBatch:
        nonlocal number, ids, texts
        data = b"".join(texts)
        gaps = mark_gaps(np.frombuffer(data, np.uint8))
        row = {
            "shard": [number],
            "ids": [np.array(ids, np.int64).tobytes()],
            "sizes": [np.array([len(t) for t in texts], np.int64).tobytes()],
            "data": [zstandard.ZstdCompressor(level=3).compress(data)],
            "gaps": [gaps.tobytes()],
        }
        number, ids, texts = number + 1, [], []
        return row_batch(row, SHARDS)

    held = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and held + len(text) > SHARD_BYTES:
                yield out()
                held = 0
            ids.append(doc)
            texts.append(text)
            held += len(text)
    if ids:
        yield out()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _key_rows(buckets: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, counts = key_runs(opened(row, bits))
            cuts = bucket_cuts(keys, buckets, bits)
            for b in range(buckets):
                part = slice(cuts[b], cuts[b + 1])
                yield row_batch({"bucket": [b], "shard": [row["shard"]], "run": [packed_keys(keys[part], counts[part])]}, RUNS)

    return run


def buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of one bucket after another, from rows in bucket order."""
    held: list[dict] = []
    for row in rows_of(batches):
        if held and held[0]["bucket"] != row["bucket"]:
            yield held[0]["bucket"], held
            held = []
        held.append(row)
    if held:
        yield held[0]["bucket"], held


def _merge_keys(hot_from: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Which keys of each run occur in another one, and which are hot, as two rows of bits."""
        for bucket, rows in buckets_of(batches):
            runs = []
            for row in rows:
                keys, counts = unpacked_keys(row["run"])
                # Occurrences in the low part, shards that hold the key above.
                runs.append((keys, counts.astype(np.int64) + (1 << 40)))
            every, seen = merge_runs(runs, np.add)
            shared, hot = seen >= 2 << 40, (seen & ((1 << 40) - 1)) > hot_from
            for row, (keys, _) in zip(rows, runs):
                at = present(every, keys)
                flags = np.packbits(shared[at]).tobytes() + np.packbits(hot[at]).tobytes()
                yield row_batch({"bucket": [bucket], "shard": [row["shard"]], "run": [flags]}, RUNS)

    return run


def shard_contexts(row: dict, buckets: int, bits: int) -> tuple[Shard, Contexts]:
    shard = opened(row, bits)
    keys, counts = key_runs(shard)
    cuts = bucket_cuts(keys, buckets, bits)
    flags = {f["bucket"]: f["run"] for f in row["flags"]}
    shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    for b in range(buckets):
        n = cuts[b + 1] - cuts[b]
        flag_bits = np.frombuffer(flags[b], np.uint8)
        half = len(flag_bits) // 2
        shared[cuts[b] : cuts[b + 1]] = np.unpackbits(flag_bits[:half], count=n)
        hot[cuts[b] : cuts[b + 1]] = np.unpackbits(flag_bits[half:], count=n)
    return shard, contexts(shard, keys, counts, shared, hot, bits)


def _context_rows(key_buckets: int, buckets: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            shard, found = shard_contexts(row, key_buckets, bits)
            cuts = bucket_cuts(found.key, buckets, bits)
            for b in np.flatnonzero(np.diff(cuts)):
                blob = packed_contexts(shard, found, cuts[b], cuts[b + 1])
                yield row_batch({"bucket": [int(b)], "shard": [row["shard"]], "run": [blob]}, RUNS)

    return run


def _merge_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in buckets_of(batches):
        parts = [unpacked_contexts(row["run"]) for row in rows]
        flags = decided(*(np.concatenate([p[i] for p in parts]) for i in range(4)))
        ends = np.cumsum([len(p[0]) for p in parts])
        for row, own in zip(rows, np.split(flags, ends[:-1])):
            yield row_batch({"bucket": [bucket], "shard": [row["shard"]], "run": [zstandard.ZstdCompressor().compress(own.tobytes())]}, RUNS)


SPANS = "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"


def _removed(key_buckets: int, buckets: int, bits: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            shard, found = shard_contexts(row, key_buckets, bits)
            cuts = bucket_cuts(found.key, buckets, bits)
            gone_bits = np.zeros(len(found.key), np.uint32)
            for f in row["answers"] or []:
                part = slice(cuts[f["bucket"]], cuts[f["bucket"] + 1])
                gone_bits[part] = np.frombuffer(zstandard.ZstdDecompressor().decompress(f["run"], max_output_size=4 * (part.stop - part.start) + 1), np.uint32)
            # Later documents of the shard lose every string of a context, its first one those that occur earlier elsewhere.
            later = shard.ids[found.doc] > found.least_id[found.of]
            own = np.where(later, np.uint32(0xFFFFFFFF), gone_bits[found.of])
            context = np.repeat(np.arange(len(own)), found.count)
            inside = np.arange(len(context)) - np.repeat(np.cumsum(found.count) - found.count, found.count)
            gone = (own[context] >> inside.astype(np.uint32) & np.uint32(1)).astype(bool)
            starts = (found.low[context] + inside)[gone]
            edge = np.bincount(starts, minlength=len(shard.data) + 1) - np.bincount(starts + STRING, minlength=len(shard.data) + 1)
            covered = np.cumsum(edge[: len(shard.data)]) > 0
            ids, sizes, spans, kept = [], [], [], []
            begin = 0
            for doc, end in zip(shard.ids.tolist(), shard.ends.tolist()):
                mask = covered[begin:end]
                turns = np.flatnonzero(np.diff(mask, prepend=False, append=False))
                ids.append(doc)
                sizes.append(end - begin)
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(turns[::2], turns[1::2])])
                kept.append(shard.data[begin:end][~mask].tobytes())
                begin = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
            )

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the bytes of 50-byte strings that also start in a document with a smaller id: (doc_id, n_bytes, spans, kept).

    Strings are judged on the input; ``spans`` are the maximal removed runs and ``kept`` the remaining bytes. Results are exact.

    Documents are gathered into shards. Each 50-byte string is named by the least hash among its 20-byte grams, so equal
    strings have equal marks. The sorted mark keys of all shards are merged by binary search, which tells the marks that
    occur in more than one shard. Only their contexts (the strings of a mark overlap, so a context is little longer than one
    string) are dealt by mark, and there suffix arrays and common prefixes find equal strings and their
    smallest ids, part by part, with the parts' runs merged by binary search (equal contexts go in once, and not at all
    where a mark has only one). Marks that occur very often are dealt
    string by string, so a passage in any share of the documents is spread. Shards are stored bucketed and joined with
    the answers without moving their texts again.

    One row per input row. Null texts are empty. Rows that share an id are one document and keep their own strings; rows
    without an id are kept whole and count for nothing; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).cast("binary").alias("text"))
    alone = read.filter(F.col("doc_id").isNull())
    alone = alone.select("doc_id", F.length("text").cast("long").alias("n_bytes"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"), F.col("text").alias("kept"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_shards_{uuid.uuid4().hex}"
    schema = "shard long, ids binary, sizes binary, data binary, gaps binary"
    made = read.filter(F.col("doc_id").isNotNull()).mapInArrow(_make_shards, schema)
    made.write.bucketBy(width, "shard").sortBy("shard").option("path", scratch_path(spark, "shards")).saveAsTable(name)
    shards = spark.table(name)
    marks = shards.agg(F.coalesce(F.sum(F.length("gaps")), F.lit(0)).alias("n")).first()["n"] // 2
    bits = min(64, max(1, marks).bit_length() + SPARE_BITS)
    hot_from = min(HOT, max(8, marks // HOT_SHARE))
    key_buckets = max(1, -(-marks * 9 // BUCKET_BYTES))
    runs = "bucket long, shard long, run binary"

    def dealt(rows: DataFrame, n: int) -> DataFrame:
        # A bucket's number is its partition: no two buckets meet by chance of a hash while there are parts enough.
        parts = min(n, 4096)
        return rows.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket", "shard")

    def per_shard(rows: DataFrame, column: str) -> DataFrame:
        return rows.groupBy(F.col("shard").alias("of_shard")).agg(F.collect_list(F.struct("bucket", "run")).alias(column))

    keys = dealt(shards.mapInArrow(_key_rows(key_buckets, bits), runs), key_buckets)
    flags = materialised(keys.mapInArrow(_merge_keys(hot_from), runs))
    flagged = shards.join(per_shard(flags, "flags"), F.col("shard") == F.col("of_shard")).drop("of_shard")
    # A shared mark's context takes some 40 bytes when compressed; a quarter of the marks is expected to be shared.
    buckets = max(1, -(-marks * 10 // BUCKET_BYTES))
    met = dealt(flagged.mapInArrow(_context_rows(key_buckets, buckets, bits), runs), buckets)
    answers = materialised(met.mapInArrow(_merge_contexts, runs))
    answered = flagged.join(per_shard(answers, "answers"), F.col("shard") == F.col("of_shard"), "left").drop("of_shard")
    return answered.mapInArrow(_removed(key_buckets, buckets, bits), SPANS).unionByName(alone)


def digest(cleaned: DataFrame) -> DataFrame:
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
