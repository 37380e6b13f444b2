"""Filter interaction audit: what every filter removes, alone and after every order of the others.

1. ``sketch``: a counting Bloom filter of text hashes, in segments named by a hash's leading bits. Tasks send the counters they
   touched, sums are taken a segment at a time, and a bit a counter says whether it reached two.
2. ``repeats_test``: a text with a counter below two occurs once and is cleared. Up to ``SKETCH_BYTES`` of bits are sent to
   all tasks; beyond that distinct hashes meet their segment in a join, and the answers join the rows.
3. Texts that are left, one copy from each task, are grouped by the whole text for the least id (``first_ids``).
4. Each row's flags become a mask; rows are counted by part and mask, with labels, and all orders of the filters are sums
   over at most 2^filters counts a part.

A row repeats if a smaller id has the same text. Null texts are empty ones. Null ids come last: they repeat any id's text, and
nothing repeats theirs. Rows with the same id don't make each other repeats. Rows of a null part belong to the part ''. Several
labels of an id count as good (or toxic) if one of them says so; null ids have no labels. Very long texts are measured by Spark
expressions and shuffled only if they may repeat. An empty table has no parts and gives no rows. Columns of ``docs`` and
``labels`` other than those named are not read, whatever their names. Only a count and the sketch reach the driver.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, hashing

#: Counters of a segment (a power of two), counters a row, and counters that a text touches.
SEGMENT_BITS, COUNTERS_PER_ROW, TOUCHED = 18, 8, 3
#: Bytes of the sketch that every task may hold.
SKETCH_BYTES = 64 << 20
#: Hashes that a task holds before it sends their counters.
HELD = 1 << 20
SENT = "segment long, at binary, n binary"


def segments_for(rows: int) -> int:
    """Bits that name a segment, for so many rows."""
    return max(0, math.ceil(math.log2(max(1, rows * COUNTERS_PER_ROW))) - SEGMENT_BITS)


def counters(keys: np.ndarray, bits: int) -> np.ndarray:
    """The counters of each hash, one row a hash, numbered through all segments."""
    mixed = hashing.mix(keys)
    segment = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    mask = np.uint64((1 << SEGMENT_BITS) - 1)
    return np.stack([(segment << np.uint64(SEGMENT_BITS)) | ((mixed >> np.uint64(SEGMENT_BITS * i)) & mask) for i in range(TOUCHED)], 1).astype(np.int64)


def _touched(bits: int):
    """Counters that a task's hashes touch, with how often, by segment."""

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        at, n = np.unique(counters(np.concatenate(held), bits), return_counts=True)
        named, starts = np.unique(at >> SEGMENT_BITS, return_index=True)
        ends = np.append(starts[1:], len(at))
        place, n = (at & ((1 << SEGMENT_BITS) - 1)).astype(np.int32), np.minimum(n, 2).astype(np.uint8)
        return pa.record_batch(
            [
                pa.array(named),
                base.binary_column([place[s:e].tobytes() for s, e in zip(starts, ends)]),
                base.binary_column([n[s:e].tobytes() for s, e in zip(starts, ends)]),
            ],
            names=["segment", "at", "n"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            size += len(held[-1])
            if size >= HELD:
                yield sent(held)
                held, size = [], 0
        if size:
            yield sent(held)

    return work


def _summed(table: pa.Table) -> pa.Table:
    """One bit a counter of a segment: whether all tasks together reached two."""
    total = np.zeros(1 << SEGMENT_BITS, np.int64)
    for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist()):
        total[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.uint8)
    return pa.table({"segment": table.column("segment").slice(0, 1), "bits": base.binary_column([np.packbits(total >= 2).tobytes()])})


def sketch(hashes: DataFrame, bits: int) -> DataFrame:
    """``(segment, bits)`` of a frame of hashes."""
    return hashes.mapInArrow(_touched(bits), SENT).groupBy("segment").applyInArrow(_summed, "segment long, bits binary")


def _reached(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all counters of each row reached two."""
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)


def _asked(bits: int):
    """Distinct hashes of a segment that its sketch doesn't clear."""
    mask = (1 << SEGMENT_BITS) - 1

    def work(keys: pa.Table, found: pa.Table) -> pa.Table:
        if not keys.num_rows:
            return base.empty(hash=pa.int64())
        column = keys.column("hash").combine_chunks()
        at = counters(column.to_numpy().view(np.uint64), bits) & mask
        return pa.table({"hash": column.filter(pa.array(_reached(np.frombuffer(found.column("bits")[0].as_py(), np.uint8), at)))})

    return work


def repeats_test(hashes: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """From the column ``hash`` of all rows, what adds ``maybe`` to rows with that column: false only if a hash occurs once."""
    spark = hashes.sparkSession
    bits = segments_for(hashes.count())
    found = base.stored(sketch(hashes, bits), "sketch")
    if (1 << bits) * (1 << SEGMENT_BITS) // 8 > SKETCH_BYTES:
        segment = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")
        keys = hashes.distinct().select("hash", segment.alias("segment"))
        answers = keys.groupBy("segment").cogroup(found.groupBy("segment")).applyInArrow(_asked(bits), "hash long")
        held = base.stored(answers, "maybe").withColumn("maybe", F.lit(True))
        return lambda rows: rows.join(held, "hash", "left").withColumn("maybe", F.coalesce("maybe", F.lit(False)))
    packed = np.zeros((1 << bits, (1 << SEGMENT_BITS) // 8), np.uint8)
    for row in found.collect():
        packed[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    everywhere = spark.sparkContext.broadcast(packed.ravel())

    @F.arrow_udf("boolean")
    def maybe(keys: pa.Array) -> pa.Array:
        return pa.array(_reached(everywhere.value, counters(keys.to_numpy().view(np.uint64), bits)))

    return lambda rows: rows.withColumn("maybe", maybe("hash"))


def first_ids(rows: DataFrame) -> DataFrame:
    """``(key, known, id)`` of rows ``(doc_id, text)``: what an id, or any null id, must be not to be (or to be) a repeat."""
    least = rows.groupBy("text").agg(F.min("doc_id").alias("first")).filter("first IS NOT NULL")
    both = F.array(
        F.struct(F.lit(True).alias("known"), F.col("first").alias("id")), F.struct(F.lit(False).alias("known"), F.lit(0).cast("long").alias("id"))
    )
    return least.select(text_key(F.col("text")).alias("key"), F.inline(both))


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def mask_counts(
    docs: DataFrame, fails: Column, n_fails: int, part: Column, labels: DataFrame, good: Column, toxic: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: rows of each part by the filters they fail; bit i for the i-th of ``fails``, an array of
    booleans, and bit ``n_fails`` for repeats."""
    base.prepare(docs.sparkSession)
    bit = [F.when(F.get(fails, F.lit(i)), 1 << i).otherwise(0) for i in range(n_fails)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    judged = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("id"), F.col(f"`{id_col}`").isNotNull().alias("known"),
        F.coalesce(part.cast("string"), F.lit("")).alias("part"), sum(bit, F.lit(0)).alias("mask"), text.alias("text"), F.xxhash64(text).alias("hash"),
    )
    test = repeats_test(texts.select("hash"))
    flags = test(judged).select("id", "known", "part", "mask", F.when(F.col("maybe"), text_key(F.col("text"))).alias("key"))
    # Rows of one id, or of none, become one for each key before they are shuffled.
    flags = flags.groupBy("id", "known", "part", "mask", "key").agg(F.count("*").alias("n"))
    first = first_ids(test(texts).filter("maybe")).withColumn("met", F.lit(True))
    met = F.coalesce("met", F.lit(False))
    joined = flags.join(first, ["key", "known", "id"], "left")
    repeat = F.when(F.col("key").isNotNull() & (met != F.col("known")), 1 << n_fails).otherwise(0)
    masked = joined.select("id", "known", "part", (F.col("mask") + repeat).alias("mask"), "n")
    masked = masked.groupBy("id", "known", "part", "mask").agg(F.sum("n").alias("n"))
    one = lambda c: F.max(F.coalesce(c, F.lit(False)).cast("long"))
    labelled = labels.filter(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("id"), F.lit(True).alias("known"))
    marked = masked.join(labelled.agg(one(good).alias("good"), one(toxic).alias("toxic")), ["id", "known"], "left")
    of = lambda c: F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0))
    return marked.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic"))


def every_order(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step, from ``mask_counts``; sums over a part's masks, of which there are few."""
    steps = []
    for order in itertools.permutations(range(len(names))):
        for step, f in enumerate(order):
            name = "".join(names[i] for i in order)
            steps.append({"filter_order": name, "step": step + 1, "bit": 1 << f, "earlier": sum(1 << i for i in order[:step])})
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, bit: int, earlier: int>>")
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    rows = parts.select("part", "masks", F.inline(listed))
    orders = math.factorial(len(names))

    def total(kept, what: str = "n", times=None) -> Column:
        value = lambda m: m[what] if times is None else m[what] * times(m)
        return F.aggregate(F.filter("masks", kept), F.lit(0).cast("long"), lambda t, m: t + value(m))

    fails = lambda m: m["mask"].bitwiseAND(F.col("bit")) != 0
    gone = lambda m: m["mask"].bitwiseAND(F.col("earlier")) != 0
    here = lambda m: fails(m) & ~gone(m)
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total(here).alias("removed"),
        total(lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda m: m["mask"] == F.col("bit")).alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        # Among the filters that a row fails each comes first in an equal share of the orders.
        total(fails, "n", lambda m: F.floor(F.lit(orders) / F.bit_count(m["mask"]))).alias("shapley"),
    )
