"""Periodic runs of words by the branching-tandem test on an enhanced suffix array, without tree nodes.

A run is a maximal stretch of words with smallest period q, at least ``least_words`` long and at least ``periods``
times q. Documents are worked on by themselves, many at a time in numpy:

1. ``SuffixArray``: prefix doubling on (document, word) orders the suffixes; the ranks of every doubling are kept. They
   give the LCP of neighbours, and the equality of any two stretches, in a logarithmic number of look-ups.
2. ``branching_squares``: LCP intervals come as bounds from range minima. In an interval of depth d, every suffix i outside
   the largest child asks whether ISA[i + d] or ISA[i - d] lies in the interval but in another child: then the word
   sequence of length d is repeated there at once and can't be rotated to the right.
3. ``find_runs``: each square is rotated to the left as far as its period holds; squares of one run, or of multiples of its
   period, meet in the same stretch, of which the least period stays.

Words are compared by 64-bit hashes; the words of every run found are then compared byte by byte, and a batch whose hashes
met falls back to exact codes. A null text has no words, as have an empty and a blank one; repeated rows are judged each by
itself; equal runs can't occur, runs are ordered by start, then period. Memory follows the longest document: about 4 bytes a
word for each doubling, at most log2 of its words. An empty table gives an empty one. Columns named as the result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, hashing

LEAST_WORDS, PERIODS = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = "n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string"


def _starts(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _last_true(flags: np.ndarray) -> np.ndarray:
    """The position of the last true value up to each position."""
    return np.maximum.accumulate(np.where(flags, np.arange(len(flags)), 0))


class SuffixArray:
    """Suffixes of the words of many documents, ordered by document and then by their first ``depth`` words or more."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, depth: int):
        n, size = len(codes), np.diff(offsets)
        self.begin, self.end = np.repeat(offsets[:-1], size), np.repeat(offsets[1:], size)
        order = np.lexsort((codes, self.begin))
        rank = np.empty(n, np.int32)
        rank[order] = _last_true(_starts(codes[order]) | _starts(self.begin[order]))
        #: ``levels[k]``: equal where the 2^k words from two places are equal; a stretch that the document ends is like no other.
        self.levels = [rank]
        step = 1
        while step <= depth:
            live = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
            if not len(live):
                break
            after = live + step
            inside = after < self.end[live]
            key = rank[live].astype(np.int64) * (n + 1) + np.where(inside, rank[np.where(inside, after, 0)].astype(np.int64) + 1, 0)
            order = np.argsort(key, kind="stable")
            live, key = live[order], key[order]
            old = rank[live]
            rank = rank.copy()
            rank[live] = old + _last_true(_starts(key)) - _last_true(_starts(old))
            self.levels.append(rank)
            step *= 2
        self.sa = np.argsort(rank, kind="stable")
        self.isa = np.empty(n, np.int64)
        self.isa[self.sa] = np.arange(n)

    def lcp(self) -> np.ndarray:
        """Common words of each suffix and the one before it in the order; at least 2^top where they share as many."""
        out = np.zeros(len(self.sa), np.int64)
        first = self.levels[0][self.sa]
        at = np.flatnonzero(~_starts(first))
        a, b = self.sa[at - 1], self.sa[at]
        # The shorter of the two suffixes ends first.
        end, shared = self.end[b], np.zeros(len(at), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + shared, b + shared
            inside = np.maximum(x, y) < end
            same = inside & (self.levels[k][np.where(inside, x, 0)] == self.levels[k][np.where(inside, y, 0)])
            shared += same * (1 << k)
        out[at] = shared
        return out

    def back(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """The leftmost place from which words ``period`` apart stay equal up to ``at``."""
        at, begin, top = at.copy(), self.begin[at], len(self.levels) - 1
        for k in range(top, -1, -1):
            live = np.arange(len(at))
            while len(live):
                x = at[live] - (1 << k)
                inside = x >= begin[live]
                x = np.where(inside, x, 0)
                same = inside & (self.levels[k][x] == self.levels[k][x + np.where(inside, period[live], 0)])
                live = live[same]
                at[live] -= 1 << k
                if k < top:
                    break
        return at


def _minima(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """``[k][i]``: the minimum of the 2^k values from i."""
    out, span = [values], 1
    while span * 2 <= longest:
        out.append(np.minimum(out[-1][:-span], out[-1][span:]))
        span *= 2
    return out


def _interval(minima: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last suffix of the LCP interval of ``depth`` around each place."""
    low, high = at.copy(), at + 1
    for k in range(len(minima) - 1, -1, -1):
        m, span = minima[k], 1 << k
        x = low - span
        low -= span * ((x >= 0) & (m[np.maximum(x, 0)] >= depth))
        inside = high < len(m)
        high += span * (inside & (m[np.where(inside, high, 0)] >= depth))
    return low - 1, high - 1


def branching_squares(s: SuffixArray, periods: int = PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """Places and half-lengths of squares that can't be rotated to the right and have copies ``periods`` - 2 halves to the left.
    Intervals with fewer than ``periods`` suffixes, or deeper than that share of their document, hold none."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lcp = s.lcp()
    n = len(lcp)
    space = (s.end - s.begin)[s.sa]
    # Among periods - 1 neighbouring values around a place, some stretch must hold the place's depth.
    wide = periods - 1
    if n < wide + 1:
        return none
    padded = np.concatenate((np.zeros(wide - 1, np.int64), lcp, np.zeros(wide - 1, np.int64)))
    runs = base.sliding_min(padded, wide)
    most = -base.sliding_min(-runs, wide)
    at = np.flatnonzero((lcp > 0) & (most >= lcp) & (lcp * periods <= space))
    if not len(at):
        return none
    starts, ends = base.runs(lcp > 0)
    low, high = _interval(_minima(lcp, int((ends - starts).max())), at, lcp[at])
    depth = lcp[at]
    order = np.lexsort((at, depth, low))
    at, low, high, depth = at[order], low[order], high[order], depth[order]
    # One group an interval; its children start at its first suffix and at each place of its depth.
    head = _starts(low) | _starts(depth)
    heads = np.flatnonzero(head)
    group = np.cumsum(head) - 1
    stop = np.where(np.append(head[1:], True), high + 1, np.append(at[1:], 0))
    first, last = np.concatenate((low[heads], at)), np.concatenate((at[heads], stop))
    of = np.concatenate((np.arange(len(heads)), group))
    # All children but the largest, the leftmost of several.
    order = np.lexsort((first, first - last, of))
    small = np.ones(len(order), bool)
    small[order[np.flatnonzero(_starts(of[order]))]] = False
    first, last, of = first[small], last[small], of[small]
    low, high, depth = low[heads], high[heads], depth[heads]
    found = []
    for lo, hi in _slices(last - first):
        child = np.repeat(np.arange(lo, hi), (last - first)[lo:hi])
        p, g = s.sa[base.ranges(first[lo:hi], (last - first)[lo:hi])], of[child]
        d, l, h = depth[g], low[g], high[g]

        def held(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Whether a place lies in the same document and the same interval, and its rank."""
            inside = (place >= s.begin[p]) & (place < s.end[p])
            rank = s.isa[np.where(inside, place, 0)]
            return inside & (rank >= l) & (rank <= h), rank

        for square in (p, p - d):
            other, rank = held(square + d if square is p else square)
            good = other & ((rank < first[child]) | (rank >= last[child]))
            for back in range(1, periods - 1):
                good &= held(square - back * d)[0]
            found.append((square[good], d[good]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else none


def _slices(sizes: np.ndarray, most: int = 1 << 20):
    """Stretches of ``sizes`` that sum up to about ``most``."""
    total, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def find_runs(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST_WORDS, periods: int = PERIODS) -> np.ndarray:
    """Runs of documents of coded words as rows ``(start, end, period)``, ordered."""
    if not len(codes):
        return np.zeros((0, 3), np.int64)
    s = SuffixArray(codes, offsets, int(np.diff(offsets).max()) // periods)
    at, period = branching_squares(s, periods)
    end = at + 2 * period
    start = s.back(at, period)
    good = end - start >= np.maximum(least, periods * period)
    start, end, period = start[good], end[good], period[good]
    order = np.lexsort((period, end, start))
    order = order[_starts(start[order]) | _starts(end[order])] if len(order) else order
    out = np.stack([start, end, period], 1)[order]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, found: np.ndarray) -> bool:
    """Whether words one period apart are equal byte by byte in all runs."""
    left = np.unique(base.ranges(found[:, 0], found[:, 1] - found[:, 0] - found[:, 2]) * np.int64(1 << 32) + np.repeat(found[:, 2], found[:, 1] - found[:, 0] - found[:, 2]))
    a = left >> 32
    b = a + (left & 0xFFFFFFFF)
    size = ends[a] - starts[a]
    if (size != ends[b] - starts[b]).any():
        return False
    return bool((data[base.ranges(starts[a], size)] == data[base.ranges(starts[b], size)]).all())


def _exact_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw, known = data.tobytes(), {}
    return np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)


def runs_of_texts(data: np.ndarray, offsets: np.ndarray, least: int = LEAST_WORDS, periods: int = PERIODS):
    """Runs of the texts of a batch and their words: ``(runs, starts, ends, first word of each text)``."""
    starts, ends, first = hashing.word_bounds(data, offsets)
    found = find_runs(hashing.word_hashes(data, starts, ends), first, least, periods)
    if not _same_words(data, starts, ends, found):
        found = find_runs(_exact_codes(data, starts, ends), first, least, periods)
    return found, starts, ends, first


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each document with one space between, as bytes and offsets."""
    doc = hashing.owner(first, np.arange(len(starts)))[keep] if len(starts) else np.zeros(0, np.int64)
    a, size = starts[keep], (ends - starts)[keep]
    lead = ~_starts(doc)
    # A word takes the byte before it along, which is then made a space; at a document's start it doesn't.
    at = base.ranges(a - lead, size + lead)
    out = data[np.maximum(at, 0)] if len(data) else data
    ends_out = np.cumsum(size + lead)
    out[(ends_out - size - lead)[lead]] = 0x20
    per_doc = np.bincount(doc, size + lead, len(first) - 1).astype(np.int64)
    return out, np.concatenate(([0], np.cumsum(per_doc)))


def periodic(text: Column, least: int = LEAST_WORDS, periods: int = PERIODS) -> Column:
    """``struct<n_words, runs, collapsed>`` of a text: its runs with starts as word numbers, and the text without the words of
    each run after its first period, words joined by one space."""

    @F.arrow_udf(RESULT)
    @base.trimmed
    def found(texts: pa.Array) -> pa.Array:
        data, offsets = base.flat(texts)
        n_words, n_runs, columns, pieces = [], [], [], []
        for _, _, d, o in base.chunks(data, offsets):
            runs, starts, ends, first = runs_of_texts(d, o, least, periods)
            edges = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edges, runs[:, 1], -1)
            doc = hashing.owner(first, runs[:, 0])
            n_words.append(np.diff(first))
            n_runs.append(np.bincount(doc, minlength=len(first) - 1))
            columns.append(np.stack([runs[:, 0] - first[doc], runs[:, 1] - runs[:, 0], runs[:, 2]]))
            pieces.append(_joined(d, starts, ends, first, np.cumsum(edges[:-1]) == 0))
        words, counts = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (n_words, n_runs))
        start, length, period = np.concatenate([np.zeros((3, 0), np.int64), *columns], 1)
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(RUN))
        cuts = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        sizes = np.concatenate([np.zeros(0, np.int64), *[np.diff(o) for _, o in pieces]])
        joined = np.concatenate([np.zeros(0, np.uint8), *[b for b, _ in pieces]])
        place = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        texts_out = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(place), pa.py_buffer(joined)])
        return pa.StructArray.from_arrays(
            [pa.array(words), pa.ListArray.from_arrays(cuts, runs), texts_out.cast(pa.string())], ["n_words", "runs", "collapsed"]
        )

    return found(text.cast("string"))


def with_runs(docs: DataFrame, text_col: str = "text", into: str = "periodic", least: int = LEAST_WORDS, periods: int = PERIODS) -> DataFrame:
    """The columns of ``docs`` and the struct ``into`` of ``periodic``."""
    base.prepare(docs.sparkSession)
    return docs.withColumn(into, periodic(F.col(f"`{text_col}`"), least, periods))
