"""Suffix arrays to a bounded depth, common prefixes and merging of sorted runs, in numpy."""

from __future__ import annotations

import numpy as np

# Positions that Kasai's walk handles side by side.
LANES = 4096


def words_at(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every position as a little-endian number; zeros follow the end. A view, so index it."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, strides=(1,))


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` bytes (at least 8), ties in text order.

    Larsson and Sadakane: suffixes are sorted by their first eight bytes; then only groups that are not told apart yet are
    sorted by the rank of the suffix that follows the compared part, which doubles each time. The last step is
    shortened so that exactly ``depth`` bytes count. Zeros follow the end of the data.
    """
    n = len(data)
    key = words_at(data).byteswap()
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = sorted_key[1:] != sorted_key[:-1]
    # A group's rank is the place of its first suffix; past the end lies rank 0 of its own.
    rank = np.zeros(n + depth + 1, np.int64)
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = first + 1
    compared = 8
    while compared < depth:
        step = min(compared, depth - compared)
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            break
        members = order[places]
        own, following = rank[members], rank[members + step]
        sort = np.lexsort((members, following, own))
        members, own, following = members[sort], own[sort], following[sort]
        order[places] = members
        new = np.ones(len(places), bool)
        new[1:] = (own[1:] != own[:-1]) | (following[1:] != following[:-1])
        fresh[places] = new
        rank[members] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))] + 1
        compared += step
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, at most ``most`` bytes.

    Kasai's walk in text order, where the prefix shrinks by at most one from position to position. The text is walked in
    lanes side by side; each lane carries its own prefix.
    """
    n = len(data)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    padded = np.concatenate([data, np.zeros(most + 16, np.uint8)])
    word = np.ndarray((len(padded) - 8,), "<u8", padded, strides=(1,))
    out = np.zeros(n, np.int64)
    lanes = min(LANES, n)
    length = -(-n // lanes) if n else 0
    starts = np.arange(lanes) * length
    carried = np.zeros(lanes, np.int64)
    for step in range(length):
        at = starts + step
        live = at < n
        at = at[live]
        before = place[at] - 1
        # Behind an equal part of full depth the next suffixes may stand the other way round, so nothing carries over.
        held = np.where((before >= 0) & (carried[live] < most), np.maximum(carried[live] - 1, 0), 0)
        other = order[np.maximum(before, 0)]
        open_lanes = np.flatnonzero(before >= 0)
        while len(open_lanes):
            h = held[open_lanes]
            differ = word[at[open_lanes] + h] ^ word[other[open_lanes] + h]
            # Equal bytes at the low end of the words.
            low = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
            held[open_lanes] = np.minimum(h + equal, most)
            open_lanes = open_lanes[(equal == 8) & (held[open_lanes] < most)]
        carried[live] = held
        out[place[at]] = np.minimum(held, n - np.maximum(at, other))
    if n:
        out[0] = 0
    return out


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], join) -> tuple[np.ndarray, np.ndarray]:
    """One sorted run of distinct keys from several, pair by pair; ``join`` combines the values of equal keys."""
    while len(runs) > 1:
        runs = [_merged(runs[i], runs[i + 1], join) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0]


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], join) -> tuple[np.ndarray, np.ndarray]:
    """Binary search places the keys of the shorter run in the longer one."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    if not len(b[0]):
        return a
    at = np.searchsorted(a[0], b[0])
    found = a[0][np.minimum(at, len(a[0]) - 1)] == b[0]
    values = a[1].copy()
    values[at[found]] = join(values[at[found]], b[1][found])
    lone, lone_at = ~found, at[~found]
    total = len(a[0]) + int(lone.sum())
    place = lone_at + np.arange(len(lone_at))
    from_a = np.ones(total, bool)
    from_a[place] = False
    keys, joined = np.empty(total, a[0].dtype), np.empty(total, values.dtype)
    keys[from_a], keys[place] = a[0], b[0][lone]
    joined[from_a], joined[place] = values, b[1][lone]
    return keys, joined


def present(keys: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Places in ``keys`` of each key of ``run``, which all occur there."""
    return np.searchsorted(keys, run)
