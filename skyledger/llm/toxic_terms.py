"""Terms of toxic texts, learned per language from a bounded sample of labels.

A key of a word is the whole word or one of its beginnings of ``BEGINNINGS`` letters, in lower case (A-Z and the Latin-1
letters), hashed to 64 bits. Words are runs of letters and of bytes above 127, of any length. ``learn`` counts keys on the
executors in at most about ``SAMPLE`` toxic and as many other labelled documents a language, chosen by a hash of their id,
each document at most ``CAP`` times a key. A key is a term if at least ``LEAST_DOCS`` toxic documents hold it, if it is
``LEAST_RATIO`` times as frequent in toxic as in other text, if chance doesn't explain that among all keys seen
(``LEAST_EVIDENCE``, in nats), and if it holds up: the sample is halved, and in each half a toxic document holds it and it is
``LEAST_HELD`` times as frequent. A beginning must stand for ``LEAST_FORMS`` different words of toxic texts, so that the stem of a
single word takes no harmless words along. Only terms reach the driver, ``MOST_TERMS`` a language, those of most evidence.

A document is matched with the terms of its language; of a language without labels, or of none, with those of all.
Null ids, texts and labels are never learned from; without toxic labels, or without others, there are no terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import base, hashing

SAMPLE, CAP, MOST_TERMS = 2000, 8, 4096
BEGINNINGS = (5, 6, 7, 8, 10)
LEAST_DOCS, LEAST_RATIO, LEAST_EVIDENCE, LEAST_HELD, LEAST_FORMS = 3, 12.0, 12.0, 4.0, 4
#: What is counted of a key in each half of the sample: toxic documents, and occurrences in toxic and in other texts.
COUNTED = [f"{c}{h}" for c in ("docs", "toxic", "other") for h in (0, 1)]

#: Sets keys of whole words apart from those of beginnings.
WHOLE = np.uint64(1)

_APART = np.ones(256, bool)
_APART[97:123] = _APART[128:] = False


@dataclass(frozen=True)
class Terms:
    """Sorted keys by language; ``""`` has those of all."""

    keys: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def langs(self) -> list[str]:
        return sorted(self.keys)

    def of(self, lang: str | None) -> np.ndarray:
        return self.keys.get(lang or "", self.keys.get("", np.zeros(0, np.uint64)))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, starts and ends of words, and the document of each."""
    low = hashing.lowered(data)
    if len(low):
        wide = np.flatnonzero((low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)) + 1
        low[wide] += np.uint8(32)
    starts, ends, _ = hashing.word_bounds(low, offsets, _APART)
    return low, starts, ends, hashing.owner(offsets, starts)


def word_keys(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of key, the words that have one and their keys."""
    if not len(starts):
        return
    sums = hashing.prefix(hashing.CODES[low])
    yield np.arange(len(starts)), hashing.spans(sums, starts, ends) ^ WHOLE
    letter = np.flatnonzero((low & 0xC0) != 0x80)
    first = np.searchsorted(letter, starts)
    size = np.searchsorted(letter, ends) - first
    letter = np.append(letter, len(low))
    for n in BEGINNINGS:
        at = np.flatnonzero(size >= n)
        if len(at):
            yield at, hashing.spans(sums, starts[at], letter[first[at] + n])


def among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted array."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def hits(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """How many words of each document have a key among ``known`` of the document's group."""
    n = len(offsets) - 1
    if not any(map(len, known)):
        return np.zeros(n, np.int64)
    low, starts, ends, doc = words(data, offsets)
    found, group = np.zeros(len(starts), bool), groups[doc]
    for at, keys in word_keys(low, starts, ends):
        for g in np.unique(group[at]):
            mine = group[at] == g
            found[at[mine]] |= among(keys[mine], known[g])
    return np.bincount(doc[found], minlength=n).astype(np.int64)


def _pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where a pair of two sorted columns differs from the one before it."""
    return np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """COUNTED per language and key; key null for the words of all."""
    for batch in batches:
        lang = np.array([x or "" for x in batch.column("lang").to_pylist()], object)
        bad, half = np.array(batch.column("bad").to_pylist(), bool), np.array(batch.column("half").to_pylist(), np.int64)
        data, offsets = base.flat(batch.column("text"))
        for first, last, d, o in base.chunks(data, offsets, 1 << 20):
            low, starts, ends, doc = words(d, o)
            names, group = np.unique(lang[first:last].astype(str), return_inverse=True)
            toxic, part = bad[first:last], half[first:last]
            cols: list[list] = [[], [], *[[] for _ in COUNTED]]
            for at, keys in word_keys(low, starts, ends):
                order = np.lexsort((doc[at], keys))
                k, w = keys[order], doc[at][order]
                head = _pairs(k, w)
                times = np.minimum(np.diff(np.append(head, len(k))), CAP)
                k, w = k[head], w[head]
                order = np.lexsort((k, group[w]))
                k, w, times = k[order], w[order], times[order]
                head = _pairs(k, group[w])
                each = [m * n for m, n in ((toxic[w], 1), (toxic[w], times), (~toxic[w], times))]
                cols[0].append(names[group[w[head]]])
                cols[1].append(k[head].view(np.int64))
                for i, (x, h) in enumerate((x, h) for x in each for h in (0, 1)):
                    cols[2 + i].append(np.add.reduceat(x * (part[w] == h), head))
            if not cols[0]:
                continue
            lines = [np.concatenate(c) for c in cols]
            n_words = np.bincount(doc, minlength=last - first)
            in_all = [[int(n_words[(group == g) & (toxic == t) & (part == h)].sum()) for g in range(len(names))] for t in (True, False) for h in (0, 1)]
            none = [0] * len(names)
            yield pa.record_batch(
                [pa.array([*lines[0], *names], pa.string()), pa.array([*lines[1].tolist(), *[None] * len(names)], pa.int64())]
                + [pa.array(np.concatenate((x, y)).astype(np.int64)) for x, y in zip(lines[2:], [none, none, *in_all])],
                names=["lang", "key", *COUNTED],
            )


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct ``(lang, key, word)`` of beginnings and the words that start with them."""
    for batch in batches:
        lang = np.array([x or "" for x in batch.column("lang").to_pylist()], object)
        data, offsets = base.flat(batch.column("text"))
        for first, last, d, o in base.chunks(data, offsets, 1 << 20):
            low, starts, ends, doc = words(d, o)
            names, group = np.unique(lang[first:last].astype(str), return_inverse=True)
            whole = np.zeros(len(starts), np.uint64)
            for i, (at, keys) in enumerate(word_keys(low, starts, ends)):
                if i == 0:
                    whole = keys
                    continue
                g = group[doc[at]]
                order = np.lexsort((whole[at], keys, g))
                g, k, w = g[order], keys[order], whole[at][order]
                head = np.union1d(_pairs(g, k), _pairs(k, w))
                yield pa.record_batch(
                    [pa.array(names[g[head]].astype(object), pa.string()), pa.array(k[head].view(np.int64)), pa.array(w[head].view(np.int64))],
                    names=["lang", "key", "word"],
                )


def evidence(toxic: Column, other: Column, n_toxic: int, n_other: int) -> tuple[Column, Column]:
    """Ratio of rates, smoothed, and the log likelihood gained over the other texts' rate."""
    expected = (other + 0.5) / (n_other + 1) * max(n_toxic, 1)
    return toxic / expected, toxic * F.log(toxic / expected) - toxic + expected


def learn(docs: DataFrame, labels: DataFrame, toxic: Column, lang: Column | None = None, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Terms:
    """Terms from ``docs`` and the condition ``toxic`` on the columns of ``labels``."""
    base.prepare(docs.sparkSession)
    said = labels.select(F.col(f"`{id_col}`").alias("doc_id"), toxic.cast("boolean").alias("bad")).filter("doc_id IS NOT NULL AND bad IS NOT NULL").distinct()
    lang = F.lit("") if lang is None else F.coalesce(lang.cast("string"), F.lit(""))
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang"))
    # Ids and languages only: the texts are not shuffled for a sample of them.
    marked = base.stored(named.select("doc_id", "lang").join(said, "doc_id"), "marked")
    kinds = {(r["lang"], r["bad"]): r["n"] for r in marked.groupBy("lang", "bad").agg(F.count("*").alias("n")).collect()}
    langs = sorted(x for x, b in kinds if b and (x, False) in kinds)
    if not langs:
        return Terms()
    part = F.lit(False)
    for x in langs:
        for b in (False, True):
            bound = min(2**63 - 1, int(2**64 * min(1.0, sample / kinds[x, b])) - 2**63)
            part = part | ((F.col("lang") == x) & (F.col("bad") == b) & (F.xxhash64("doc_id") <= bound))
    chosen = base.stored(marked.filter(part).distinct(), "chosen")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    chosen = base.stored(named.filter("text IS NOT NULL").join(chosen, ["doc_id", "lang"]).select("lang", "bad", half, "text"), "sample")
    counted = chosen.mapInArrow(_counted, "lang string, key long, " + ", ".join(f"{c} long" for c in COUNTED))
    counted = counted.groupBy("lang", "key").agg(*[F.sum(c).alias(c) for c in COUNTED])
    counted = base.stored(counted.filter("key IS NULL OR (docs0 > 0 AND docs1 > 0)"), "terms")
    fits, gain = F.lit(False), F.lit(0.0)
    for r in counted.filter("key IS NULL").collect():
        ratio, more = evidence(F.col("toxic0") + F.col("toxic1"), F.col("other0") + F.col("other1"), r["toxic0"] + r["toxic1"], r["other0"] + r["other1"])
        mine = (F.col("lang") == r["lang"]) & (ratio >= LEAST_RATIO)
        for h in (0, 1):
            mine = mine & (evidence(F.col(f"toxic{h}"), F.col(f"other{h}"), r[f"toxic{h}"], r[f"other{h}"])[0] >= LEAST_HELD)
        fits, gain = fits | mine, F.when(mine, more).otherwise(gain)
    found = counted.filter(F.col("key").isNotNull() & (F.col("docs0") + F.col("docs1") >= LEAST_DOCS) & fits)
    found = found.select("lang", "key", gain.alias("gain")).filter(F.col("gain") >= LEAST_EVIDENCE)
    forms = chosen.filter("bad").mapInArrow(_forms, "lang string, key long, word long").groupBy("lang", "key").agg(F.count_distinct("word").alias("forms"))
    # Whole words have no forms.
    found = found.join(forms, ["lang", "key"], "left").filter(F.coalesce("forms", F.lit(LEAST_FORMS)) >= LEAST_FORMS)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("gain"), "key"))
    rows = found.withColumn("place", place).filter(F.col("place") <= MOST_TERMS).select("lang", "key").collect()
    keys = {x: np.unique(np.array([r["key"] for r in rows if r["lang"] == x], np.int64).view(np.uint64)) for x in langs}
    keys[""] = np.unique(np.concatenate([*keys.values()]))
    return Terms(keys)
