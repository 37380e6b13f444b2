"""Hashes of all substrings and word sequences of a batch at once, in numpy.

A prefix sum of coded symbols times powers of an odd base gives the hash of any range by a subtraction; the
difference is scaled back by the inverse power and mixed, so it doesn't depend on where the range lies.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
CODES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: ASCII white space that separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    up, down = _powers(size)
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def prefix(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums of coded symbols, one longer than the input."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(len(symbols))[0], out=out[1:])
    return out


def grams(sums: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` symbols from every position."""
    n = len(sums) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[size:] - sums[:n]) * powers(n)[1])


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range; ranges of different length differ."""
    down = powers(int(starts.max()) + 1 if len(starts) else 1)[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, which never cross documents, and the first word of each document (and the end)."""
    inside = ~space[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spans(prefix(CODES[data]), starts, ends)


def inside(offsets: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether ``size`` symbols from each of the first ``n`` positions lie in one document."""
    edges = np.zeros(n + 1, np.int32)
    length = np.diff(offsets)
    fits = length >= size
    np.add.at(edges, offsets[:-1][fits], 1)
    np.add.at(edges, (offsets[1:] - size + 1)[fits], -1)
    return np.cumsum(edges[:n]) > 0


def owner(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The document that each position lies in."""
    return np.searchsorted(offsets, positions, "right") - 1
