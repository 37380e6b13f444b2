"""Suffix-array dedup: repeated byte windows across documents by a depth-limited radix sort.

A suffix is ordered only through its first ``window`` bytes, by most-significant-digit passes that drop every
group left with one document; equal groups after the last digit are exactly the windows of several documents.

So that a corpus needn't move all its suffixes, each window is represented by one *anchor*, the position of the
smallest ``gram``-byte hash inside it. Equal windows have equal anchors at equal offsets, so

1. ``_anchor_keys``: the leading digit, the gram at the anchor, is counted over the corpus (``blocks``); grams of
   one document are dropped,
2. ``_records``: the rest go to the bucket of their gram as their bytes, at most once per block and context,
3. ``_sorted_bucket``: a bucket refines its records by 8-byte digits, then, where a gram has several contexts, the
   windows of each offset by the digits that are left, and answers with one bit per window,
4. ``_removed``: each block turns its bits into removed spans.

Results are judged on the input, not on what is left. A document's null text is empty. Null ids order last, so their
documents remove nothing from others. Rows with equal ids don't remove each other's bytes. Texts shorter than a window
are kept whole; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import base, blocks, hashing

WINDOW, GRAM = 50, 24
#: Leading bits of a gram's hash that are compared beyond those that name the bucket; a chance match costs work only.
GRAM_BITS = 30
#: A bucket of grams is this many bits of buckets of records, which are larger than grams.
RECORD_BITS = 4
LAST_ID = np.iinfo(np.int64).max


class Anchors:
    """Anchors of all windows of a run of documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        n = len(data) - window + 1
        self.at = self.first = self.last = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        if n <= 0:
            return
        key = hashing.grams(hashing.prefix(hashing.CODES[data]), gram)
        ranked = (key & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(key), dtype=np.uint64)
        at = (base.sliding_min(ranked, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(hashing.inside(offsets, window, n))
        if not len(starts):
            return
        at = at[starts]
        new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        #: Anchor position, the first and last window start that it stands for, and its gram's hash.
        self.at, self.first, self.last = at[new], starts[new], starts[np.append(new[1:], len(starts)) - 1]
        # The least hashes were picked, so they are mixed once more to fill all buckets alike.
        self.key = hashing.mix(key[self.at] + np.uint64(1))


def _anchor_keys(window: int, gram: int, bits: int):
    kept = bits + GRAM_BITS

    def keys(table: pa.Table) -> pa.Table:
        data, offsets = base.flat(table.column("text"))
        found = [Anchors(d, o, window, gram).key for _, _, d, o in base.chunks(data, offsets)]
        distinct = blocks.distinct_keys(np.concatenate(found), min(64, kept)) if found else np.zeros(0, np.uint64)
        blk = table.column("blk")[0].as_py()
        return pa.Table.from_batches([blocks.send(blk, distinct, np.ones(len(distinct), np.uint8), bits, min(64, kept))])

    return keys


def _several(group: np.ndarray, vals: np.ndarray, n: int) -> np.ndarray:
    return (np.bincount(group, minlength=n) > 1)[group].astype(np.uint8)


class BlockRecords:
    """The records of a block: anchors of repeated grams with the bytes of their windows, distinct ones once."""

    def __init__(self, table: pa.Table, answers: pa.Table, window: int, gram: int, bits: int):
        kept = min(64, bits + GRAM_BITS)
        self.data, self.offsets = base.flat(table.column("text"))
        ids = table.column("doc_id")
        self.ids = ids.fill_null(LAST_ID).to_numpy() if ids.null_count else ids.to_numpy()
        parts = []
        for first, _, d, o in base.chunks(self.data, self.offsets):
            a = Anchors(d, o, window, gram)
            parts.append((a.at, a.first, a.last, a.key, np.full(len(a.at), self.offsets[first])))
        if parts:
            at, first, last, key, shift = (np.concatenate(x) for x in zip(*parts))
            at, first, last = at + shift, first + shift, last + shift
        else:
            at = first = last = np.zeros(0, np.int64)
            key = np.zeros(0, np.uint64)
        drop = np.uint64(64 - kept)
        cut = (key >> drop) << drop
        distinct, place = np.unique(cut, return_inverse=True)
        # Grams of several documents in this block, or of several blocks.
        doc = self.ids[hashing.owner(self.offsets, at)] if len(at) else np.zeros(0, np.int64)
        low, high = np.full(len(distinct), LAST_ID), np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(low, place, doc)
        np.maximum.at(high, place, doc)
        repeated = (low != high) | (blocks.told(answers, "u1") > 0)
        live = repeated[place]
        self.at, self.first, self.last, self.doc = at[live], first[live], last[live], doc[live]
        key = key[live]
        reach = window - gram
        before, after = self.at - self.first, self.at - self.last
        # The bytes of all windows of the anchor; bytes outside them are zero.
        column = np.arange(window + reach)
        self.context = np.zeros((len(self.at), window + reach), np.uint8)
        whole = before.astype(np.uint64) * np.uint64(257) + after.astype(np.uint64)
        for lo in range(0, len(self.at), 1 << 14):
            rows = slice(lo, lo + (1 << 14))
            where = (self.at[rows] - reach)[:, None] + column
            mine = (column >= (reach - before[rows])[:, None]) & (column < (reach - after[rows] + window)[:, None])
            self.context[rows] = np.where(mine, self.data[np.where(mine, where, 0)], 0)
            for digit in _digits(self.context[rows]):
                whole[rows] = hashing.mix(whole[rows] ^ digit)
        self.before, self.after = before.astype(np.uint8), after.astype(np.uint8)
        # Distinct (gram bucket, context) in a fixed order, with the smallest document of each.
        bucket = (key >> np.uint64(64 - bits - RECORD_BITS)).astype(np.int64)
        order = np.lexsort((whole, bucket))
        new = np.concatenate(([True], (whole[order][1:] != whole[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])))[: len(order)]
        self.pick = order[new]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.bucket = bucket[self.pick]
        self.low = np.full(len(self.pick), LAST_ID)
        np.minimum.at(self.low, self.place, self.doc)


def _records(window: int, gram: int, bits: int):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blocks.no_blobs()
        r = BlockRecords(table, answers, window, gram, bits)
        used, starts = np.unique(r.bucket, return_index=True)
        ends = np.append(starts[1:], len(r.bucket))
        blk = table.column("blk")[0].as_py()
        rows = [r.pick[s:e] for s, e in zip(starts, ends)]
        return pa.table(
            {
                "blk": pa.array(np.full(len(used), blk, np.int64)),
                "bucket": pa.array(used),
                "keys": base.binary_column([r.context[p].tobytes() for p in rows]),
                "vals": base.binary_column(
                    [r.low[s:e].tobytes() + r.before[p].tobytes() + r.after[p].tobytes() for s, e, p in zip(starts, ends, rows)]
                ),
            }
        )

    return send


def msd_passes(digits: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Refine groups digit by digit, most significant first, and drop groups left with one document.

    Returns the surviving members and their final groups.
    """
    live = np.arange(len(doc))
    for digit in digits:
        if not len(live):
            break
        d = digit[live]
        order = np.lexsort((d, group))
        live, group, d = live[order], group[order], d[order]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (d[1:] != d[:-1])))
        firsts = np.flatnonzero(new)
        names = np.cumsum(new) - 1
        low, high = np.minimum.reduceat(doc[live], firsts), np.maximum.reduceat(doc[live], firsts)
        keep = (low != high)[names]
        live, group = live[keep], names[keep]
    return live, group


def _digits(windows: np.ndarray) -> list[np.ndarray]:
    """Big-endian 8-byte digits of equally long strings."""
    n, width = windows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = windows
    return list(padded.view(">u8").astype(np.uint64).T)


def _sorted_bucket(window: int, gram: int):
    reach, width = window - gram, 2 * window - gram
    step = 8 + 1 + 1

    def judge(batches: pa.Table) -> pa.Table:
        blks, contexts, vals = batches.column("blk").to_numpy(), batches.column("keys").to_pylist(), batches.column("vals").to_pylist()
        sizes = np.array([len(v) // step for v in vals])
        context = np.frombuffer(b"".join(contexts), np.uint8).reshape(-1, width)
        doc = np.concatenate([np.frombuffer(v, np.int64, n) for v, n in zip(vals, sizes)])
        before = np.concatenate([np.frombuffer(v, np.uint8, n, 8 * n) for v, n in zip(vals, sizes)])
        after = np.concatenate([np.frombuffer(v, np.uint8, n, 9 * n) for v, n in zip(vals, sizes)])
        mask = np.zeros((len(doc), -(-(reach + 1) // 8)), np.uint8)
        every = np.zeros(len(doc), bool)
        live, group = msd_passes(_digits(context[:, reach : reach + gram]), np.zeros(len(doc), np.int64), doc)
        # Equal contexts of one gram: all but the smallest document's lose every window.
        sides = [*_digits(context[live]), before[live].astype(np.uint64) << np.uint64(8) | after[live]]
        order = np.lexsort((doc[live], *sides, group))
        new = np.concatenate(([True], _changes([group, *sides], order)))[: len(order)]
        firsts = np.flatnonzero(new)
        low = doc[live][order][firsts] if len(firsts) else doc[:0]
        names = np.cumsum(new) - 1
        every[live[order]] = doc[live][order] > low[names] if len(order) else False
        # Grams with several contexts: one member of each goes on, window by window.
        heads, of = order[firsts], group[order[firsts]]
        mixed = (np.bincount(of, minlength=int(of.max()) + 1 if len(of) else 0) > 1)[of]
        heads, of = live[heads[mixed]], of[mixed]
        for back in range(reach + 1):
            here = np.flatnonzero((after[heads] <= back) & (back <= before[heads]))
            rows = heads[here]
            if not len(rows):
                continue
            members, final = msd_passes(_digits(context[rows, reach - back : reach - back + window]), of[here], doc[rows])
            if len(members):
                cut = np.flatnonzero(np.concatenate(([True], final[1:] != final[:-1])))
                least = np.repeat(np.minimum.reduceat(doc[rows[members]], cut), np.diff(np.append(cut, len(members))))
                gone = rows[members[doc[rows[members]] > least]]
                mask[gone, back >> 3] |= np.uint8(1 << (back & 7))
        mask[every] = 255
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "blk": pa.array(blks),
                "bucket": batches.column("bucket"),
                "keys": base.binary_column([b""] * len(blks)),
                "vals": base.binary_column([mask[e - s : e].tobytes() for s, e in zip(sizes, ends)]),
            }
        )

    return judge


def _changes(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    changed = np.zeros(max(0, len(order) - 1), bool)
    for k in keys:
        k = k[order]
        changed |= k[1:] != k[:-1]
    return changed


def _removed(window: int, gram: int, bits: int, whole_characters: bool = False):
    reach = window - gram
    lanes = -(-(reach + 1) // 8)

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        rest = [table.column("rest")] if "rest" in table.column_names else []
        if not table.num_rows:
            kind = pa.string() if whole_characters else pa.binary()
            none = base.empty(doc_id=pa.int64(), kept=kind, spans=SPANS, n_bytes=pa.int64())
            return none.append_column("rest", rest[0]) if rest else none
        second = np.array(answers.column("step").to_pylist()) == 2
        r = BlockRecords(table, answers.filter(pa.array(~second)), window, gram, bits)
        mask = blocks.told(answers.filter(pa.array(second)), "u1").reshape(-1, lanes)
        edges = np.zeros(len(r.data) + 1, np.int32)
        # A smaller document of this block with the same windows, or an answer for all of them.
        whole = (r.doc > r.low[r.place]) | (mask[r.place] == 255).all(1) if len(r.at) else np.zeros(0, bool)
        np.add.at(edges, r.first[whole], 1)
        np.add.at(edges, r.last[whole] + window, -1)
        for back in range(reach + 1):
            hit = (mask[r.place, back >> 3] >> (back & 7) & 1).astype(bool) & ~whole & (r.after <= back) & (back <= r.before) if len(r.at) else whole
            np.add.at(edges, r.at[hit] - back, 1)
            np.add.at(edges, r.at[hit] - back + window, -1)
        gone = np.cumsum(edges[:-1]) > 0
        kept, spans = [], []
        for s, e in zip(r.offsets[:-1], r.offsets[1:]):
            part = gone[s:e]
            if part.any():
                starts, ends = base.runs(part)
                kept.append(r.data[s:e][~part].tobytes())
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)])
            else:
                kept.append(r.data[s:e].tobytes())
                spans.append([])
        left = pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if whole_characters else base.binary_column(kept)
        columns = [table.column("doc_id"), left, pa.array(spans, SPANS), pa.array(np.diff(r.offsets)), *rest]
        return pa.table(columns, names=[*COLUMNS, "rest"][: len(columns)])

    return cut


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
COLUMNS = ("doc_id", "kept", "spans", "n_bytes")
RESULT = "doc_id long, kept binary, spans array<struct<start:long,end:long>>, n_bytes long"


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, carry: Sequence[str] = (),
    whole_characters: bool = False,
) -> DataFrame:
    """``(doc_id, kept, spans, n_bytes)`` per row: bytes covered by a ``window``-byte string that also starts in a
    document with a smaller id are cut; ``spans`` are the maximal cut runs, ``kept`` the bytes that are left. Columns
    named in ``carry`` come along in a struct ``rest``. With ``whole_characters``, ``kept`` is text, and of a character
    that is cut in two nothing stays."""
    base.prepare(docs.sparkSession)
    rows, _, total = blocks.in_blocks(docs, id_col, text_col, carry=carry)
    bits = blocks.bucket_bits(total * 2 / (window - gram + 2))
    dealt = rows.groupBy("blk")
    sent = dealt.applyInArrow(base.trimmed(_anchor_keys(window, gram, bits)), blocks.BLOB)
    seen = sent.groupBy("bucket").applyInArrow(base.trimmed(lambda t: blocks.answer(_several, "u1", t)), blocks.BLOB)
    records = dealt.cogroup(seen.groupBy("blk")).applyInArrow(base.trimmed(_records(window, gram, bits)), blocks.BLOB)
    judged = records.groupBy("bucket").applyInArrow(base.trimmed(_sorted_bucket(window, gram)), blocks.BLOB)
    both = seen.withColumn("step", F.lit(1)).unionByName(judged.withColumn("step", F.lit(2)))
    schema = T.StructType.fromDDL(RESULT.replace("kept binary", "kept string") if whole_characters else RESULT)
    if carry:
        schema = schema.add("rest", rows.schema["rest"].dataType)
    return dealt.cogroup(both.groupBy("blk")).applyInArrow(base.trimmed(_removed(window, gram, bits, whole_characters)), schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The columns of ``docs``, the text without its repeats; of a character that is cut in two, nothing stays. A null
    text stays null."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    named = docs.select(id_.alias("doc_id"), text.alias("text"), text.isNull().alias("absent"), F.struct(*others).alias("others"))
    found = remove_repeats(named, window=window, gram=gram, carry=["absent", "others"], whole_characters=True)
    text = F.when(~F.col("rest.absent"), F.col("kept"))
    return found.select(*[(text if c == text_col else F.col(f"rest.others.`{c}`")).alias(c) for c in docs.columns])
