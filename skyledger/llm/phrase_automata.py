"""Substring dedup by repeated-phrase automata.

1. *Candidates*: every ``window``-word sequence is represented by its smallest ``gram``-word hash; grams seen once in the
   corpus are dropped (``blocks``).
2. *Confirm*: the window sequences around the other grams are counted over the corpus by 64-bit hash; those that start
   at two places or more recur.
3. *Compile*: each block of documents joins its recurring windows to passages and compiles an Aho-Corasick automaton of
   window-long phrases that tile them. Automata are sharded with the documents: a phrase that recurs in a block is in
   that block's automaton, so a document need only pass through its own.
4. *Stream*: all documents of the block run through the automaton; every occurrence of a phrase is removed.

Words are runs of characters other than ASCII white space, unchanged. Windows never cross documents and are judged on
the input. Null or blank texts have no words and are kept as empty; texts of fewer words than a window lose nothing;
repeated rows recur in each other; an empty table gives an empty one.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, blocks, hashing

WINDOW, GRAM = 35, 8
GRAM_BITS = 30
#: Characters of phrases in one automaton; a block with more is streamed through several.
AUTOMATON_CHARS = 2 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words per text byte, for the number of buckets.
WORDS_PER_BYTE = 1 / 6


class Sequences:
    """Words of a run of documents, with the hashes of the windows at their anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.starts, self.ends, self.first_word = hashing.word_bounds(data, offsets)
        self.at = self.window_first = self.window_last = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        n = len(self.starts) - window + 1
        if n <= 0:
            return
        self.sums = hashing.prefix(hashing.word_hashes(data, self.starts, self.ends))
        key = hashing.grams(self.sums, gram)
        ranked = (key & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(key), dtype=np.uint64)
        at = (base.sliding_min(ranked, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        valid = np.flatnonzero(hashing.inside(self.first_word, window, n))
        if not len(valid):
            return
        at = at[valid]
        new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        self.at, self.window_first, self.window_last = at[new], valid[new], valid[np.append(new[1:], len(valid)) - 1]
        # The least hashes were picked, so they are mixed once more to fill all buckets alike.
        self.key = hashing.mix(key[self.at] + np.uint64(1))

    def windows(self, live: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows that the chosen anchors stand for."""
        starts = base.ranges(self.window_first[live], (self.window_last - self.window_first + 1)[live])
        return starts, hashing.spans(self.sums, starts, starts + window) if len(starts) else np.zeros(0, np.uint64)


def _cut(keys: np.ndarray, kept: int) -> np.ndarray:
    drop = np.uint64(64 - kept)
    return (keys >> drop) << drop


def _sequences(table: pa.Table, window: int, gram: int):
    data, offsets = base.flat(table.column("text"))
    for first, last, d, o in base.chunks(data, offsets):
        yield first, last, d, o, Sequences(d, o, window, gram)


def _counted(table: pa.Table, keys: np.ndarray, bits: int, kept: int) -> pa.Table:
    distinct, counts = np.unique(keys, return_counts=True)
    blk = table.column("blk")[0].as_py()
    return pa.Table.from_batches([blocks.send(blk, distinct, np.minimum(counts, 2).astype(np.uint8), bits, kept)])


def _gram_keys(window: int, gram: int, bits: int):
    kept = min(64, bits + GRAM_BITS)

    def keys(table: pa.Table) -> pa.Table:
        found = [s.key for *_, s in _sequences(table, window, gram)]
        return _counted(table, _cut(np.concatenate(found), kept), bits, kept)

    return keys


def _recurring_windows(table: pa.Table, answers: pa.Table, window: int, gram: int, bits: int):
    """Per chunk of the block: its sequences, and the starts and hashes of windows whose gram recurs."""
    kept = min(64, bits + GRAM_BITS)
    parts = list(_sequences(table, window, gram))
    cut = _cut(np.concatenate([p[-1].key for p in parts]), kept)
    _, place = np.unique(cut, return_inverse=True)
    live = blocks.told(answers, "u1")[place] > 1
    at = 0
    for first, last, d, o, s in parts:
        mine = live[at : at + len(s.key)]
        at += len(s.key)
        yield (first, last, d, o, s, *s.windows(mine, window))


def _window_keys(window: int, gram: int, bits: int):
    def keys(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blocks.no_blobs()
        found = [p[-1] for p in _recurring_windows(table, answers, window, gram, bits)]
        return _counted(table, np.concatenate(found), bits, 64)

    return keys


def passages(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Recurring window starts joined to passages of words, ``(first, last)``; neighbours overlap by all but one word."""
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(r[0]), int(r[-1]) + window) for r in np.split(starts, cut) if len(r)]


def tiles(first: int, last: int, window: int) -> list[int]:
    """Starts of windows that together cover a passage."""
    return [*range(first, last - window, window), last - window]


def compile_automata(phrases: set[str], limit: int = AUTOMATON_CHARS) -> list[ahocorasick.Automaton]:
    """Automata of at most ``limit`` characters of phrases each; the value of a phrase is its length."""
    out, size, automaton = [], 0, None
    for phrase in sorted(phrases):
        if automaton is None or size + len(phrase) > limit:
            automaton, size = ahocorasick.Automaton(), 0
            out.append(automaton)
        automaton.add_word(phrase, len(phrase))
        size += len(phrase)
    for a in out:
        a.make_automaton()
    return out


def covered_words(words: list[str], automata: list[ahocorasick.Automaton], window: int) -> np.ndarray:
    """Words inside any occurrence of a phrase; phrases and text have a space on both sides."""
    gone = np.zeros(len(words) + 1, np.int32)
    if len(words) < window:
        return gone[:-1] > 0
    text = " " + " ".join(words) + " "
    last_word = np.cumsum([len(w) + 1 for w in words])  # position of the space after each word
    ends = [end for a in automata for end, _ in a.iter(text)]
    if ends:
        after = np.searchsorted(last_word, np.unique(np.array(ends))) + 1
        np.add.at(gone, after - window, 1)
        np.add.at(gone, after, -1)
    return np.cumsum(gone[:-1]) > 0


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
RESULT = "doc_id long, kept string, spans array<struct<start:long,end:long>>, n_words long, n_removed long"


def _streamed(window: int, gram: int, bits: int):
    def stream(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return base.empty(doc_id=pa.int64(), kept=pa.string(), spans=SPANS, n_words=pa.int64(), n_removed=pa.int64())
        second = np.array(answers.column("step").to_pylist(), np.int64) == 2
        parts = list(_recurring_windows(table, answers.filter(pa.array(~second)), window, gram, bits))
        _, place = np.unique(np.concatenate([p[-1] for p in parts]), return_inverse=True)
        recurs = blocks.told(answers.filter(pa.array(second)), "u1")[place] > 1
        phrases, at = set(), 0
        for _, _, data, _, s, starts, hashes in parts:
            mine = starts[recurs[at : at + len(hashes)]]
            at += len(hashes)
            for first, last in passages(np.sort(mine), window):
                for tile in tiles(first, last, window):
                    words = data[s.starts[tile] : s.ends[tile + window - 1]].tobytes().decode()
                    phrases.add(" " + " ".join(WORD.findall(words)) + " ")
        automata = compile_automata(phrases)
        texts = table.column("text").to_pylist()
        kept, spans, n_words, n_removed = [], [], [], []
        for text in texts:
            words = WORD.findall(text or "")
            gone = covered_words(words, automata, window) if automata else np.zeros(len(words), bool)
            starts, ends = base.runs(gone)
            kept.append(" ".join(w for w, g in zip(words, gone.tolist()) if not g) if len(starts) else " ".join(words))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)])
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "kept": pa.array(kept, pa.string()),
                "spans": pa.array(spans, SPANS),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
            }
        )

    return stream


def remove_recurring(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``(doc_id, kept, spans, n_words, n_removed)`` per row: words inside a ``window``-word sequence that starts at two
    places or more of the corpus are removed, all copies alike; ``spans`` are runs of word positions, ``kept`` the other
    words joined by one space."""
    base.prepare(docs.sparkSession)
    rows, _, total = blocks.in_blocks(docs, id_col, text_col)
    bits = blocks.bucket_bits(total * WORDS_PER_BYTE * 2 / (window - gram + 2))
    dealt = rows.groupBy("blk")
    counted = base.trimmed(lambda t: blocks.answer(blocks.total_count, "u1", t))
    grams = dealt.applyInArrow(base.trimmed(_gram_keys(window, gram, bits)), blocks.BLOB).groupBy("bucket").applyInArrow(counted, blocks.BLOB)
    windows = dealt.cogroup(grams.groupBy("blk")).applyInArrow(base.trimmed(_window_keys(window, gram, bits)), blocks.BLOB)
    confirmed = windows.groupBy("bucket").applyInArrow(counted, blocks.BLOB)
    both = grams.withColumn("step", F.lit(1)).unionByName(confirmed.withColumn("step", F.lit(2)))
    return dealt.cogroup(both.groupBy("blk")).applyInArrow(base.trimmed(_streamed(window, gram, bits)), RESULT)
