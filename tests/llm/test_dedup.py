"""Dedup operators against brute force, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import adaptive_prefix_join, base, blocks, components, phrase_automata, suffix_radix
from tests.llm.conftest import awkward, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 1 << 63


@pytest.fixture
def many_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "BUCKET_KEYS", 500)
    real = blocks.in_blocks
    monkeypatch.setattr(blocks, "in_blocks", lambda d, i, t, block_bytes=4000, carry=(): real(d, i, t, block_bytes, carry))


def cut_bytes(rows, size):
    least = {}
    for i, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - size + 1):
            w = data[s : s + size]
            least[w] = min(least.get(w, LAST), LAST if i is None else i)
    out = []
    for i, text in rows:
        data, gone = (text or "").encode(), bytearray(len((text or "").encode()))
        for s in range(len(data) - size + 1):
            if least[data[s : s + size]] < (LAST if i is None else i):
                gone[s : s + size] = b"\1" * size
        out.append((i, bytes(b for b, g in zip(data, gone) if not g), sum(gone)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_byte_windows(spark, docs, many_blocks, seed):
    rows = awkward(seed)
    found = suffix_radix.remove_repeats(docs(rows)).collect()
    got = sorted(((r.doc_id, bytes(r.kept), sum(s.end - s.start for s in r.spans)) for r in found), key=repr)
    assert got == sorted(cut_bytes(rows, 50), key=repr)


def test_byte_windows_of_other_sizes(spark, docs, many_blocks):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    for window, gram in ((8, 4), (12, 5)):
        found = suffix_radix.remove_repeats(docs(rows), window=window, gram=gram).collect()
        assert sorted((r.doc_id, bytes(r.kept)) for r in found) == sorted((i, k) for i, k, _ in cut_bytes(rows, window))


def test_stage_keeps_columns_and_whole_characters(spark, docs):
    rows = [(1, "ü" * 60 + "tail"), (2, "x" + "ü" * 60), (3, None)]
    out = suffix_radix.without_repeats(docs(rows))
    assert out.columns == docs(rows).columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "ü" * 60 + "tail", 2: "x", 3: None}


def cut_words(rows, size):
    seen = Counter(tuple(w[s : s + size]) for _, t in rows for w in [WORD.findall(t or "")] for s in range(len(w) - size + 1))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s : s + size])] > 1:
                gone[s : s + size] = [True] * size
        out.append((i, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "size", "gram"), [(1, 35, 8), (3, 6, 3)])
def test_word_windows(spark, docs, many_blocks, monkeypatch, seed, size, gram):
    monkeypatch.setattr(phrase_automata, "AUTOMATON_CHARS", 600)
    rows = awkward(seed)
    found = phrase_automata.remove_recurring(docs(rows), window=size, gram=gram).collect()
    assert sorted(((r.doc_id, r.kept, r.n_words, r.n_removed) for r in found), key=repr) == cut_words(rows, size)


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def families(rows):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(100 * len(x & y) >= 75 * len(x | y) and x and y for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(((i, len(shingles(t)), None if i is None else find(i)) for i, t in rows), key=repr)


def near_family(rng, n, words=60, edits=6):
    base = sentence(rng, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(1000)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("short", "frequent", "salt_rows", "share"), [(2, 4096, 16384, 128), (24, 4096, 16384, 3), (24, 8, 3, 6), (2, 2, 5, 1)])
def test_jaccard_components(spark, docs, many_blocks, monkeypatch, short, frequent, salt_rows, share):
    """Lists in buckets, lists under salts and both, with keys looked up by broadcast, by shuffle and both."""
    for name, value in (("SHORT", short), ("FREQUENT", frequent), ("SALT_ROWS", salt_rows)):
        monkeypatch.setattr(adaptive_prefix_join, name, value)
    monkeypatch.setattr(base, "SHARE", share)
    rng = random.Random(short)
    rows = awkward(4) + [(1000 + i, t) for i, t in enumerate(near_family(rng, 70) + near_family(rng, 40, 30, 3))]
    found = adaptive_prefix_join.near_duplicates(docs(rows)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == families(rows)


def test_lists_of_frequent_tokens_stay_out_of_buckets(spark, docs, monkeypatch):
    """A family of a third of all rows: no bucket holds more than FREQUENT postings of one token, no salt many more than its share."""
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(near_family(rng, 150))] + [(500 + i, sentence(rng, 40)) for i in range(300)]
    found, _ = adaptive_prefix_join.classes(docs(rows), "doc_id", "text", 5, 75)
    sets = found.filter("tokens IS NOT NULL").select("cls", "tokens", "rarity")
    often = adaptive_prefix_join.frequency_step(16)
    schema = "bucket long, " + ", ".join(f"{c} binary" for c in adaptive_prefix_join.POSTING)
    blobs = sets.mapInArrow(adaptive_prefix_join._postings(75, 1, often), schema).collect()
    rare = Counter(t for b in blobs for t in np.frombuffer(b.token, np.uint64).view(np.int64).tolist())
    frequent = adaptive_prefix_join.frequent_postings(sets, 75, often, 20).collect()
    lists, parts = Counter(r.token for r in frequent), Counter((r.token, r.salt) for r in frequent)
    assert max(rare.values()) < 16 <= max(lists.values()) and not set(rare) & set(lists)
    assert max(lists.values()) > 60 and max(parts.values()) < 40
    everything = sets.mapInArrow(adaptive_prefix_join._postings(75, 1, 256), schema).collect()
    assert rare + lists == Counter(t for b in everything for t in np.frombuffer(b.token, np.uint64).view(np.int64).tolist())


def test_look_up_splits_off_shared_keys(spark, monkeypatch):
    rows = [(i, None if i % 7 == 0 else 1 if i % 3 == 0 else i) for i in range(90)]
    left = spark.createDataFrame(rows, "i long, k long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 60)], "k long, v string")
    for share in (1, 4, 1000):
        monkeypatch.setattr(base, "SHARE", share)
        got = sorted((r.i, r.v) for r in base.look_up(left, right, "k").select("i", F.coalesce("v", F.lit("")).alias("v")).collect())
        assert got == sorted((i, f"v{k}" if k is not None and k < 60 else "") for i, k in rows)


def test_first_of_each_keeps_one_row_a_family(spark, docs):
    text = sentence(random.Random(1), 50)
    rows = [(3, text), (1, text), (1, text), (2, "other words stand here alone"), (None, text), (5, ""), (6, "")]
    out = adaptive_prefix_join.first_of_each(docs(rows))
    assert out.columns == docs(rows).columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([(1, text), (2, rows[3][1]), (None, text), (5, ""), (6, "")], key=repr)


def test_first_of_each_loses_no_text_of_a_shared_id(spark, docs):
    """An id with several texts takes none of them along with the others."""
    a, b, c = (sentence(random.Random(i), 50) for i in (1, 2, 3))
    near = " ".join(["changed", *b.split()[1:]])
    rows = [(1, a), (1, b), (2, near), (2, near), (3, c), (3, c.upper()), (3, "short"), (3, "short"), (4, None), (4, None), (4, "")]
    for data in (rows, rows[::-1]):
        left = sorted(((r.doc_id, (r.text or "").lower()) for r in adaptive_prefix_join.first_of_each(docs(data)).collect()), key=repr)
        assert left == sorted([(1, a), (1, b), (3, c), (3, "short"), (4, ""), (4, "")], key=repr)


def test_rows_without_an_id_are_spread_over_blocks(spark, docs):
    rows = [(None, sentence(random.Random(i), 30)) for i in range(200)]
    found, n, _ = blocks.in_blocks(docs(rows), "doc_id", "text", block_bytes=2000)
    sizes = [r["count"] for r in found.groupBy("blk").count().collect()]
    assert n > 5 and len(sizes) == n and max(sizes) < 4 * 200 / n


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == nodes
    assert all((got[x] == got[y]) == (find(x) == find(y)) for x in nodes for y in nodes)


def test_empty_tables(spark, docs):
    none = docs([])
    assert suffix_radix.remove_repeats(none).count() == 0
    assert phrase_automata.remove_recurring(none).count() == 0
    assert adaptive_prefix_join.near_duplicates(none).count() == 0
    assert adaptive_prefix_join.first_of_each(none).count() == 0
