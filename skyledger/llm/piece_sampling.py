"""SentencePiece encoding and decoding by forward filtering and backward sampling over the piece lattice.

A text's lattice has an edge for every vocabulary piece at every place. Pieces hold white space only at their front and
never a line break, so the lattice falls apart at those into units, and equal units have equal lattices. Forward
filtering adds up, in logarithms, the weight of all paths to every node of each distinct unit; backward sampling walks
each occurrence from its end, picking an edge by its share of that sum, so a segmentation is drawn with its exact
probability. A pick's random number is a hash of seed, row key, unit and step, so results repeat on any cluster.

A BPE vocabulary has ranks instead of probabilities; a piece of rank r weighs 1 / (r + 1) (``sharpness`` raises that to a
power). Characters without a piece, and literal word marks, become byte pieces, so decoding is lossless.

A null text has null ids, an empty one none. A null id counts as a key of its own; rows with equal ids and texts are
segmented alike. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, hashing

#: Where the public vocabulary lies on every machine.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK, FOREIGN_MARK = 0x2581, 0x110000
UNIT = re.compile(r" *[^ \n]+| +|\n")
STEP = 0x9E3779B97F4A7C15
SLOT_BITS = 20
NULL_KEY = np.uint64(0xA5A5A5A55A5A5A5A)
#: Text bytes segmented at a time.
CHUNK = 1 << 19


@dataclass(frozen=True)
class Vocabulary:
    slots: np.ndarray  # hash of a piece or of a piece's beginning, by open addressing
    piece: np.ndarray  # its id, -1 for a mere beginning
    weight: np.ndarray  # log weight of a piece
    longest: int
    byte_ids: np.ndarray  # piece of each byte
    flat: np.ndarray  # decoded bytes of all pieces, one after the other
    at: np.ndarray
    size: np.ndarray


def _hash(code: int, symbol: int) -> int:
    x = ((code ^ symbol) * STEP) & (2**64 - 1)
    return x ^ (x >> 29)


@lru_cache(4)
def vocabulary(path: str, sharpness: float = 1.0) -> Vocabulary:
    """Read a model file; refuses vocabularies whose pieces cross units."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    byte_ids = np.zeros(256, np.int32)
    decoded, ordinary = [], []
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[1:-1], 16)] = i
            decoded.append(bytes([int(name[1:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            decoded.append(b"")
        else:
            if not re.fullmatch("▁*[^▁\n]*", name):
                raise ValueError(f"piece {name!r} crosses units")
            ordinary.append(i)
            decoded.append(name.replace("▁", " ").encode())
    ranked = sorted(ordinary, key=lambda i: (-model.get_score(i), i))
    weight = np.full(n, -np.inf)
    weight[ranked] = -sharpness * np.log(np.arange(1, len(ranked) + 1))
    weight[ranked] -= np.log(np.exp(weight[ranked]).sum())
    known: dict[int, int] = {}
    for i in ordinary:
        code = 0
        for symbol in map(ord, names[i]):
            code = _hash(code, symbol)
            known.setdefault(code, -1)
        known[code] = i
    slots, piece = np.zeros(1 << SLOT_BITS, np.uint64), np.full(1 << SLOT_BITS, -1, np.int32)
    for code, i in known.items():
        at = code >> (64 - SLOT_BITS)
        while slots[at]:
            at = (at + 1) & ((1 << SLOT_BITS) - 1)
        slots[at], piece[at] = code, i
    size = np.array([len(d) for d in decoded])
    flat = np.frombuffer(b"".join(decoded), np.uint8)
    return Vocabulary(slots, piece, weight, max(len(names[i]) for i in ordinary), byte_ids, flat, np.cumsum(size) - size, size)


def look_up(v: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash begins a piece, and the piece it is (or -1)."""
    at = (codes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    held = v.slots[at]
    open_ = np.flatnonzero((held != codes) & (held != 0))
    while len(open_):
        at[open_] = (at[open_] + 1) & ((1 << SLOT_BITS) - 1)
        held[open_] = v.slots[at[open_]]
        open_ = open_[(held[open_] != codes[open_]) & (held[open_] != 0)]
    found = held == codes
    return found, np.where(found, v.piece[at], -1)


class Lattices:
    """Lattices of distinct units with the forward sums of their nodes, edges in order of the node they end in."""

    def __init__(self, units: list[str], v: Vocabulary):
        symbols = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.fromiter(map(len, units), np.int64, len(units))
        self.symbols = symbols
        first = np.cumsum(length) - length
        unit = np.repeat(np.arange(len(units)), length)
        place = np.arange(len(symbols)) - first[unit]
        # A unit of n symbols has n + 1 nodes.
        node = np.arange(len(symbols)) + unit
        self.begin, self.end = first + np.arange(len(units)), first + length + np.arange(len(units))
        coded = np.where(symbols == 0x20, MARK, np.where(symbols == MARK, FOREIGN_MARK, symbols)).astype(np.uint64)
        at, codes = np.arange(len(symbols)), np.zeros(len(symbols), np.uint64)
        starts, spans, pieces = [], [], []
        for size in range(1, v.longest + 1):
            x = (codes ^ coded[at + size - 1]) * np.uint64(STEP)
            codes = x ^ (x >> np.uint64(29))
            found, piece = look_up(v, codes)
            hit = piece >= 0
            starts.append(at[hit]), spans.append(np.full(hit.sum(), size)), pieces.append(piece[hit])
            if size == 1:
                starts.append(at[~hit]), spans.append(np.ones((~hit).sum(), np.int64)), pieces.append(np.full((~hit).sum(), -1, np.int32))
            more = found & (place[at] + size < length[unit[at]])
            at, codes = at[more], codes[more]
            if not len(at):
                break
        start, span, piece = np.concatenate(starts), np.concatenate(spans), np.concatenate(pieces)
        weight = np.where(piece >= 0, v.weight[piece], v.weight[np.isfinite(v.weight)].min() * 2)
        target = node[start] + span
        total = np.full(len(symbols) + len(units), -np.inf)
        total[self.begin] = 0
        # Nodes by distance from their unit's begin; edges of one length into one node are single.
        when = (place[start] + span) * (v.longest + 1) + span
        # Sixteen bits, where they do, are sorted by radix.
        order = np.argsort(when.astype(np.uint16) if when.max() < 1 << 16 else when, kind="stable")
        cuts = np.flatnonzero(np.diff(when[order])) + 1
        for s, e in zip(np.concatenate(([0], cuts)), np.append(cuts, len(order))):
            rows = order[s:e]
            total[target[rows]] = np.logaddexp(total[target[rows]], total[node[start[rows]]] + weight[rows])
        order = np.argsort(target, kind="stable")
        self.origin, self.piece, self.start, target = node[start[order]], piece[order], start[order], target[order]
        share = np.exp(total[self.origin] + weight[order] - total[target])
        self.shares = np.cumsum(share)
        into = np.bincount(target, minlength=len(total))
        self.high = np.cumsum(into) - 1
        self.low = self.high - into + 1
        self.before = np.concatenate(([0.0], self.shares))[self.low]


def uniform(key: np.ndarray, unit: np.ndarray, step: int) -> np.ndarray:
    x = hashing.mix(key + unit.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(step * 0x165667B19E3779F9 & (2**64 - 1)))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _utf8_sizes(symbols: np.ndarray) -> np.ndarray:
    return 1 + (symbols >= 0x80) + (symbols >= 0x800) + (symbols >= 0x10000)


def sample(texts: list[str], keys: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, one after the other, and where each text's begin (and end)."""
    index: dict[str, int] = defaultdict(count().__next__)
    ids: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            found = UNIT.findall(" " + text)
            counts[i] = len(found)
            ids.extend(map(index.__getitem__, found))
    if not ids:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    net = Lattices(list(index), v)
    unit = np.array(ids)
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(unit)) - (np.cumsum(counts) - counts)[owner]
    key = keys[owner]
    at, first, live = net.end[unit], net.begin[unit], np.arange(len(unit))
    picks, step = [], 0
    width = np.zeros(len(unit), np.int64)
    while len(live):
        node = at[live]
        # A node with a single edge leaves nothing to draw.
        edge = net.low[node]
        open_ = np.flatnonzero(net.high[node] > edge)
        if len(open_):
            here, rows = node[open_], live[open_]
            drawn = np.searchsorted(net.shares, net.before[here] + uniform(key[rows], number[rows], step), "right")
            edge[open_] = np.clip(drawn, edge[open_], net.high[here])
        piece = net.piece[edge]
        picks.append((live, edge, piece))
        width[live] += 1
        raw = np.flatnonzero(piece < 0)
        if len(raw):
            width[live[raw]] += _utf8_sizes(net.symbols[net.start[edge[raw]]]) - 1
        origin = net.origin[edge]
        at[live] = origin
        live = live[origin != first[live]]
        step += 1
    ends = np.cumsum(width)
    out, free = np.empty(int(ends[-1]), np.int32), ends.copy()
    for rows, edge, piece in picks:
        whole = piece >= 0
        if whole.all():
            free[rows] -= 1
            out[free[rows]] = piece
        else:
            free[rows[whole]] -= 1
            out[free[rows[whole]]] = piece[whole]
            rows, symbols = rows[~whole], net.symbols[net.start[edge[~whole]]]
            raw = np.frombuffer(symbols.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
            sizes = _utf8_sizes(symbols)
            free[rows] -= sizes
            out[base.ranges(free[rows], sizes)] = v.byte_ids[raw]
    return out, np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]


def row_keys(ids: pa.Array, seed: int) -> np.ndarray:
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    keys = hashing.mix(known * np.uint64(STEP) + np.uint64((seed * 0xD1B54A32D192ED03 + 1) & (2**64 - 1)))
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), NULL_KEY, keys)


def encode(id_: Column, text: Column, seed: int = 1, path: str = MODEL, sharpness: float = 1.0) -> Column:
    """``struct<pieces, lossless>``: a sampled segmentation of each text as an array of piece ids, and whether its pieces
    were decoded to the text's own bytes again."""

    @F.arrow_udf("pieces: array<int>, lossless: boolean")
    @base.trimmed
    def encoded(ids: pa.Array, texts: pa.Array) -> pa.Array:
        v = vocabulary(path, sharpness)
        keys = row_keys(ids, seed)
        data, places = base.flat(texts)
        sizes = np.diff(places)
        cuts = [0]
        while cuts[-1] < len(texts):
            total = np.cumsum(sizes[cuts[-1] :])
            cuts.append(cuts[-1] + max(1, int(np.searchsorted(total, CHUNK, "right"))))
        pieces, offsets, shift, lossless = [], [np.zeros(1, np.int64)], 0, []
        for s, e in zip(cuts, cuts[1:]):
            out, at = sample(texts[s:e].to_pylist(), keys[s:e], v)
            lossless.append(round_trips(out, at, data[places[s] : places[e]], places[s : e + 1] - places[s], v))
            pieces.append(out)
            offsets.append(at[1:] + shift)
            shift += len(out)
        ends = np.concatenate(offsets)
        values = pa.array(np.concatenate(pieces) if pieces else np.zeros(0, np.int32))
        nothing = texts.is_null().to_numpy(zero_copy_only=False)
        at = pa.array(ends.astype(np.int32), mask=np.append(nothing, False)) if nothing.any() else pa.array(ends.astype(np.int32))
        same = pa.array(np.concatenate(lossless) if lossless else np.zeros(0, bool))
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(at, values), same], ["pieces", "lossless"])

    return encoded(id_.cast("long"), text.cast("string"))


def decoded_bytes(ids: np.ndarray, v: Vocabulary) -> np.ndarray:
    return v.flat[base.ranges(v.at[ids], v.size[ids])]


def round_trips(ids: np.ndarray, at: np.ndarray, data: np.ndarray, places: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Whether each text's ids decode to its bytes, with the space in front."""
    sizes = np.concatenate(([0], np.cumsum(v.size[ids])))
    got, want = sizes[at], np.diff(places)
    fits = np.diff(got) == want + (want > 0)
    if not fits.all():
        return fits & np.array([decoded_bytes(ids[s:e], v)[1:].tobytes() == data[a:b].tobytes() for s, e, a, b in zip(at, at[1:], places, places[1:])])
    spaced = np.zeros(int(got[-1]), np.uint8)
    front = got[:-1][want > 0]
    inside = np.ones(len(spaced), bool)
    inside[front] = False
    spaced[front], spaced[inside] = 0x20, data
    wrong = np.concatenate(([0], np.cumsum(decoded_bytes(ids, v) != spaced)))
    return wrong[got[1:]] == wrong[got[:-1]]


def decode(pieces: Column, path: str = MODEL) -> Column:
    """The text of an array of piece ids; the space that encoding puts in front is taken off again."""

    @F.arrow_udf("string")
    @base.trimmed
    def texts(lists: pa.Array) -> pa.Array:
        v = vocabulary(path)
        ends = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False)
        absent = lists.is_null().to_numpy(zero_copy_only=False)
        out = []
        for s, e, none in zip(ends[:-1], ends[1:], absent):
            out.append(None if none else decoded_bytes(ids[s:e], v)[1:].tobytes().decode())
        return pa.array(out, pa.string())

    return texts(pieces)


def segment(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, path: str = MODEL, sharpness: float = 1.0
) -> DataFrame:
    """The columns of ``docs`` with ``_pieces`` and ``_lossless``, which replace columns of these names; every
    segmentation is decoded and compared on the spot."""
    base.prepare(docs.sparkSession)
    done = docs.withColumn("_pieces", encode(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed, path, sharpness))
    return done.withColumns({"_lossless": F.col("_pieces.lossless"), "_pieces": F.col("_pieces.pieces")})
