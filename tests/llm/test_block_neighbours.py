"""Nearest neighbours against every pair in float64."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import block_neighbours
from skyledger.llm.block_neighbours import nearest

SCHEMA = "vec_id long, embedding array<{}>, label int, id string, vec int, asked int, tile long, qrow long, score double"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4, 5, 0.5) for i, v in rows], SCHEMA.format(kind))


def cosine(a, b):
    dot = na = nb = 0.0
    for x, y in zip(a, b):
        dot, na, nb = dot + x * y, na + x * x, nb + y * y
    return dot / (na**0.5 * nb**0.5)


def by_brute_force(rows, k=5, asked=lambda i: i is not None and i % 50 == 0, kind=np.float32):
    good = []
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v):
            v = [float(kind(x)) for x in v]
            if any(v):
                good.append((i, v))
    out = []
    for n, (i, v) in enumerate(good):
        if asked(i):
            near = [(-cosine(v, w), j is None, j) for m, (j, w) in enumerate(good) if m != n and len(w) == len(v)]
            out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(sorted(near, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def odd_rows(seed=5, n=400, d=24):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.02) for c in rng.choice(centres)]) for i in range(n)]
    copies = [[float(x) for x in rng.choices([-1, 0, 1], k=d)] for _ in range(2)]
    rows += [(n + i, copies[i % 2]) for i in range(120)]  # more copies than any list holds
    rows += [(2000, copies[0]), (2000, copies[0]), (2000, [2 * x for x in copies[0]]), (2050, copies[1]), (None, copies[0]), (None, rows[0][1])]
    rows += [(2100, None), (2150, []), (2200, [0.0] * d), (2250, [1.0, None] + [0.0] * (d - 2)), (2300, [float("nan")] * d), (2350, [float("inf")] * d)]
    rows += [(2400, [1.0, 2.0]), (2401, [2.0, 1.0]), (2450, [3.0]), (2500, [1e-30] * d), (2550, [-0.0] + [3e38] * (d - 1))]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_all_odd_cases(spark, rows, monkeypatch, small):
    """With few groups and with many, of few rows each."""
    if small:
        for name, value in dict(CANDIDATE_BYTES=4096, QUERY_BYTES=512, ROWS_PER_MERGE=64).items():
            monkeypatch.setattr(block_neighbours, name, value)
    data = odd_rows()
    found = nearest(frame(spark, data), F.col("vec_id") % 50 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows(found) == by_brute_force(data)


def test_tiles_of_few_rows_and_columns(monkeypatch):
    for name, value in dict(TILE_QUERIES=3, TILE_CANDIDATES=16, EXACT_COLUMNS=7, PAIRS=50).items():
        monkeypatch.setattr(block_neighbours, name, value)
    data = [r for r in odd_rows()[:520]]
    vec = pa.array([v for _, v in data], pa.list_(pa.float32()))
    table = pa.table({"id": pa.array([i for i, _ in data], pa.int64()), "vec": vec, "tile": pa.array([0] * len(data), pa.int64())})
    asked = np.flatnonzero([i % 50 == 0 for i, _ in data])
    queries = table.take(asked).append_column("qrow", pa.array(asked))
    found = block_neighbours._merged(5)(block_neighbours._tiles(5)(table, queries)).to_pylist()
    assert sorted((tuple(r.values()) for r in found), key=repr) == by_brute_force(data)


def test_doubles_out_of_the_range_of_squares(spark, rows):
    rng = random.Random(2)
    data = [(i, [rng.gauss(0, 1) * 2.0**800 for _ in range(5)]) for i in range(30)] + [(50, [rng.gauss(0, 1) * 2.0**-800 for _ in range(5)])]
    scaled = [(i, [x * 2.0 ** (-800 if i < 30 else 800) for x in v]) for i, v in data]
    assert rows(nearest(frame(spark, data, "double"), F.col("vec_id") % 50 == 0, k=3)) == by_brute_force(scaled, 3, kind=float)


def test_few_or_no_rows(spark, rows):
    one = frame(spark, [(0, [1.0, 2.0])])
    asked = F.col("vec_id") % 50 == 0
    assert rows(nearest(one, asked)) == [] and rows(nearest(one.limit(0), asked)) == []
    two = [(0, [1.0, 2.0]), (100, [2.0, 1.0])]
    assert rows(nearest(frame(spark, two), asked)) == by_brute_force(two)
    assert rows(nearest(frame(spark, two), F.lit(False))) == []


def test_bounds_hold(monkeypatch):
    """Products of codes lie as near to the cosine as the lost lengths say, and no near pair is dropped."""
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(40, 1500)), rng.normal(size=(300, 1500))
    y[:50] = x[rng.integers(0, 40, 50)] + rng.normal(size=(50, 1500)) * 0.1
    known = np.ones(300, bool)
    q, c = block_neighbours.Block(x, np.arange(40), known[:40]), block_neighbours.Block(y, np.arange(300), known)
    exact = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
    near = block_neighbours.product(q.codes, c.codes) * q.step[:, None] * c.step
    assert (np.abs(near - exact) <= q.lost[:, None] + (1 + q.lost)[:, None] * c.lost + 1e-9).all()
    i, j = block_neighbours.survivors(q, c, slice(0, 40), slice(0, 300), np.full(40, -np.inf), 6)
    kept = set(zip(i.tolist(), j.tolist()))
    assert len(kept) < 40 * 300 / 2
    assert all((n, m) in kept for n in range(40) for m in np.argsort(-exact[n])[:6].tolist())
