"""Filter orders against rows filtered one by one."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import filter_audit
from tests.llm.conftest import awkward


def by_brute_force(rows, names, fails, labels):
    """Every order applied to the rows of each part, left to right; ``fails`` lists the letters that a row fails."""
    out = []
    good, toxic = ({i for i, *marks in labels if i is not None and marks[at] == 1} for at in (0, 1))
    shapley = Counter()
    for part in {p for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, fails) if p == part]
        for order in itertools.permutations(names):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [i for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                redundant = sum(x in f for _, f in mine) - len(gone)
                shapley[part, x] += len(gone)
                unique = sum(f == {x} for _, f in mine)
                out.append((part or "", "".join(order), step, len(left), len(gone), redundant, unique, sum(i in good for i in gone), sum(i in toxic for i in gone), (part, x)))
    return sorted((*r[:-1], shapley[r[-1]]) for r in out)


def repeats(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    return [(t or "") in least and (i is None or i > least[t or ""]) for i, t, _ in rows]


def audited(spark, rows, labels):
    full = [(i, t, p, "x", 1, False, 7, 8) for i, t, p in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, part string, mask int, maybe boolean, id long, n long")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, known int").withColumn("id", F.lit(1))
    fails = F.array(F.char_length("text") < 100, F.col("text").contains("the "))
    counts = filter_audit.mask_counts(docs, fails, 2, F.col("lang"), marks, F.col("quality") == 1, F.col("toxic") == 1)
    return filter_audit.every_order(counts, "SAE")


@pytest.mark.parametrize("spread", [False, True])
def test_orders_of_odd_rows(spark, rows, monkeypatch, spread):
    """The sketch on every task, and in segments that are joined."""
    if spread:
        monkeypatch.setattr(filter_audit, "SKETCH_BYTES", 0)
        monkeypatch.setattr(filter_audit, "segments_for", lambda n: 3)
    rng = random.Random(4)
    data = [(i, t, rng.choice(["en", "de", None])) for i, t in awkward(4, 80)]
    data += [(None, "only of no id", "en")] * 3 + [(7000, "the " * 50, "fr"), (7000, "the " * 50, "fr"), (7000, "other", "fr"), (6999, "other", "de")]
    data += [(7001, data[0][1], "en"), (7001, "alone", "en")] + [(8000 + i, "copy", "en") for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1]), 5) for i, *_ in data if rng.random() < 0.7] + [(9999, 1, 1, 5), (None, 1, 1, 5), (7000, 1, 0, 5), (7000, 0, 1, 5)]
    fails = [{x for x, y in zip("SAE", (t is not None and len(t) < 100, "the " in (t or ""), e)) if y} for (_, t, _), e in zip(data, repeats(data))]
    assert rows(audited(spark, data, labels)) == sorted(by_brute_force(data, "SAE", fails, [x[:3] for x in labels]), key=repr)


def test_a_task_sends_its_counters_in_parts(monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD", 16)
    keys = np.arange(100, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    batches = [pa.record_batch([pa.array(keys[lo : lo + 7].view(np.int64))], names=["hash"]) for lo in range(0, 100, 7)]
    sent = list(filter_audit._touched(2)(iter(batches)))
    assert len(sent) > 4
    total = np.zeros(1 << 20, int)
    for segment, at, n in (r.values() for b in sent for r in b.to_pylist()):
        total[(segment << filter_audit.SEGMENT_BITS) + np.frombuffer(at, np.int32)] += np.frombuffer(n, np.uint8)
    want = np.bincount(filter_audit.counters(keys, 2).ravel(), minlength=1 << 20)
    assert ((total >= 2) == (want >= 2)).all() and (total > 0).sum() == (want > 0).sum()


def test_no_rows(spark):
    assert audited(spark, [], []).collect() == []
    one = audited(spark, [(None, None, None)], []).collect()
    assert len(one) == 18 and {r.part for r in one} == {""} and all(r.removed == 0 for r in one)


def test_sketch_clears_no_repeat_and_most_others():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 30000, dtype=np.uint64) * np.uint64(2)
    keys = np.concatenate((keys, keys[:2000]))
    bits = filter_audit.segments_for(len(keys))
    at, n = np.unique(filter_audit.counters(keys, bits), return_counts=True)
    total = np.zeros(1 << bits + filter_audit.SEGMENT_BITS, int)
    total[at] = n
    maybe = filter_audit._reached(np.packbits(total >= 2), filter_audit.counters(keys, bits))
    assert maybe[:2000].all() and maybe[30000:].all() and maybe[2000:30000].mean() < 0.05
