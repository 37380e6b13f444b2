"""Periodic runs against every period tried at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from skyledger.llm import hashing, periodic_runs
from skyledger.llm.queries import QUERIES
from tests.llm.conftest import awkward
from tests.llm.test_queries import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words, least=6, periods=4):
    """``(start, length, period)`` of every run, by trying each period; multiples of a period come later and are left out."""
    found, seen = [], set()
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                found.append((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def loops(rng):
    """Words of few kinds with repeated blocks, some inside each other."""
    out = []
    for _ in range(rng.randint(1, 4)):
        block = [rng.choice("ab") for _ in range(rng.randint(1, 6))] * rng.randint(1, 6)
        out += (block * rng.randint(1, 7))[: rng.randint(1, 90)] + [rng.choice("abc") for _ in range(rng.randint(0, 6))]
    return out


@pytest.mark.parametrize("least, periods", [(6, 4), (1, 2), (9, 3)])
def test_runs_of_batches(least, periods):
    rng = random.Random(least)
    for _ in range(250):
        docs = [loops(rng) if rng.random() < 0.8 else [] for _ in range(rng.randint(1, 5))]
        offsets = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        codes = np.array([ord(w) for d in docs for w in d], np.uint64)
        want = [(s + o, s + o + n, q) for d, o in zip(docs, offsets.tolist()) for s, n, q in runs_of(d, least, periods)]
        assert list(map(tuple, periodic_runs.find_runs(codes, offsets, least, periods).tolist())) == want


def odd_rows():
    rng = random.Random(7)
    rows = awkward(7, 20) + [(500 + i, " ".join(loops(rng))) for i in range(40)]
    long = ["w"] * 5000 + ["x", "y", "z"] * 4000 + ["Ünï"] * 5
    return rows + [(600, " ".join(long)), (601, "\x1c " * 8), (602, "\n a\tb " * 9 + "\x0b"), (600, " ".join(long))]


def expected(text):
    """Words, runs and what is left of a text; runs of the two texts too long for brute force are known from how they were made."""
    words = WORD.findall(text or "")
    if len(words) < 15000:
        runs = runs_of(words)
    else:
        runs = [(0, 5000, 1), (5000, 12000, 3)] if text.startswith("w w") else []
    return len(words), runs, collapsed(words, runs)


def test_documents(spark, docs):
    rows = odd_rows()
    frame = docs(rows).withColumnsRenamed({"_m": "periodic_runs", "cls": "runs"})
    got = periodic_runs.with_runs(frame)
    assert got.columns == [*frame.columns, "periodic"]
    found = [(r.doc_id, r.periodic.n_words, [tuple(x) for x in r.periodic.runs], r.periodic.collapsed) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(((i, *expected(t)) for i, t in rows), key=repr)


def test_words_whose_hashes_meet(monkeypatch):
    monkeypatch.setattr(hashing, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    text = "ab cd ab xy ab cd ab cd ab cd"
    found = periodic_runs.runs_of_texts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 4, 2)[0]
    assert [(s, e - s, q) for s, e, q in found.tolist()] == runs_of(text.split(), 4, 2)


def test_empty_table_and_replaced_column(spark, docs):
    assert periodic_runs.with_runs(docs([(1, "a")]).limit(0)).collect() == []
    got = periodic_runs.with_runs(docs([(1, "a " * 6)]), into="row")
    assert got.columns.count("row") == 1 and got.first()["row"]["runs"][0].length == 6


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, text in rows:
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j if j < a else a + (j - a) % p] for j in range(n)]
        runs = runs_of(w) if n < 3000 else None
        if runs is None:
            continue
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        digest = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((i, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha(digest), sha(collapsed(w, runs))))
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()}
    assert len(got) == len(rows) and sum(w[1] for w in want) > 0
    assert [got[w[0]] for w in want] == want
