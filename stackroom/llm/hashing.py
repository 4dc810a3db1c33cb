"""Vectorised 64-bit hashing of byte runs in numpy."""

from __future__ import annotations

import numpy as np

# Steps and multipliers of the mixing function, and an odd base with its inverse modulo 2**64.
STEP = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB
BASE = 0x5851F42D4C957F2D


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread function of 64-bit numbers."""
    x = x + np.uint64(STEP)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from the high bits."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        take = min(done, n - done)
        out[done : done + take] = out[:take] * step
        done += take
    return out[:n] if n else out[:0]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of data[start:end] for every pair, from one running sum of byte times power."""
    up = powers(len(data) + 1, base)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    down = powers(len(data) + 1, pow(base, -1, 1 << 64))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
