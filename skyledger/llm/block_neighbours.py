"""Exact nearest neighbours by cosine as a block matrix join of int8 tiles.

1. Query rows are written once with a number each. Rows are dealt at random into groups of candidates and queries into groups
   of queries, of bounded bytes each; a task gets one group of either (``cogroup``), the smaller side copied to meet the other.
2. ``Block``: unit vectors are rounded to int8 codes with a step of their own; the length of what rounding lost is kept.
3. ``tile``: products of codes are whole numbers, summed exactly by a float32 matrix product of at most 1024 columns. With
   the lengths lost they bound the cosine: |cos - product| <= e_q + (1 + e_q) * e_c. A pair survives if its upper bound
   reaches the query's (k+1)-th best so far, or the tile's (k+1)-th lower bound.
4. Surviving pairs are recomputed in float64 from the original vectors, summed in the order of the components, so equal
   vectors score alike wherever they lie, and go to a heap per query.
5. Sorted lists of all groups are merged by heaps, and one row equal to the query itself is left out.

Bounds only spare work: results are exact. Nearness ties go to the smaller id, null ids last. Vectors that are null, empty, zero
or hold null or non-finite components take no part; vectors meet those of their own length only. Repeated rows are rows of
their own: each is a candidate of the others, and each repeated query is answered. Of equal vectors in a group only the k+1
smallest ids can be among the nearest, so a group of copies costs no more than k+1 rows. Fewer candidates than k give
fewer rows; no queries or an empty table give none. Only three counts reach the driver. Other columns are not read.
"""

from __future__ import annotations

import heapq
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base

K = 5
#: Bytes of original vectors in a group of candidates and of queries; a task holds one of each and some copies.
CANDIDATE_BYTES, QUERY_BYTES = 16 << 20, 16 << 20
#: Least rows of a candidate group, while there are fewer groups than cores.
LEAST_ROWS = 2048
#: Rows of a tile, and the columns whose products of codes a float32 sums without rounding.
TILE_QUERIES, TILE_CANDIDATES, EXACT_COLUMNS = 512, 4096, 1024
#: What float32 scaling may add to a product, and pairs recomputed at a time.
SLACK, PAIRS = 1e-5, 1 << 17
FOUND = "qrow long, piece long, nth int, query_id long, vec_id long, score double, own boolean"
TYPES = {
    "qrow": pa.int64(), "piece": pa.int64(), "nth": pa.int32(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64(), "own": pa.bool_()
}
NEAREST = "query_id long, rank int, vec_id long, score double"
ROWS_PER_MERGE = 1 << 16


def usable(vec: Column) -> Column:
    """Whether a vector takes part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(vec.isNotNull() & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0), F.lit(False))


class Block:
    """Vectors of one length with their ids, columns first: as they are, and as int8 codes of unit vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, known: np.ndarray, row: np.ndarray | None = None):
        self.ids, self.known, self.row = ids, known, row
        v = vectors.astype(np.float64)
        # A power of two changes no cosine and keeps squares in range.
        v = np.ldexp(v, -np.frexp(np.abs(v).max(1))[1][:, None])
        self.columns = np.ascontiguousarray(v.T)
        self.square = ordered_sum(c * c for c in self.columns)
        self.norm = np.sqrt(self.square)
        unit = v / self.norm[:, None]
        self.step = np.abs(unit).max(1) / 127
        codes = np.rint(unit / self.step[:, None])
        self.lost = np.sqrt(((unit - codes * self.step[:, None]) ** 2).sum(1)) * (1 + 1e-9) + 1e-12
        self.codes = codes.astype(np.int8)

    def __len__(self) -> int:
        return len(self.ids)


def ordered_sum(terms) -> np.ndarray:
    """Sum of equally long arrays, in their order."""
    total = None
    for t in terms:
        total = t.copy() if total is None else np.add(total, t, out=total)
    return total


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows, whole numbers, in float32 (float64 beyond EXACT_COLUMNS)."""
    out = None
    for lo in range(0, a.shape[1], EXACT_COLUMNS):
        part = a[:, lo : lo + EXACT_COLUMNS].astype(np.float32) @ b[:, lo : lo + EXACT_COLUMNS].astype(np.float32).T
        out = part if out is None else out.astype(np.float64) + part
    return out


def cosines(q: Block, c: Block, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Cosines of pairs in float64, summed in the order of the components."""
    out = np.empty(len(qi))
    for lo in range(0, len(qi), PAIRS):
        i, j = qi[lo : lo + PAIRS], ci[lo : lo + PAIRS]
        dot = ordered_sum(x[i] * y[j] for x, y in zip(q.columns, c.columns))
        out[lo : lo + PAIRS] = dot / (q.norm[i] * c.norm[j])
    return out


def survivors(q: Block, c: Block, queries: slice, candidates: slice, best: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile whose upper bound reaches the query's ``best``, or the tile's k-th lower bound."""
    near = product(q.codes[queries], c.codes[candidates])
    near *= c.step[candidates].astype(near.dtype)
    lost, step = q.lost[queries], q.step[queries]
    bound = lost + (1 + lost) * c.lost[candidates].max() + SLACK
    asked = best[queries]
    if near.shape[1] >= k:
        fresh = np.flatnonzero(asked == -np.inf)
        if len(fresh):
            kth = np.partition(near[fresh], near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            asked = asked.copy()
            asked[fresh] = kth * step[fresh] - bound[fresh]
    least = np.nextafter(((asked - bound) / step).astype(near.dtype), np.array(-np.inf, near.dtype))
    i, j = np.nonzero(near >= least[:, None])
    return i + queries.start, j + candidates.start


def fewest_copies(vectors: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Rows but those with ``most`` equal vectors earlier in ``order``."""
    key = np.ascontiguousarray(vectors[order]).view(np.dtype((np.void, vectors.shape[1] * vectors.itemsize))).ravel()
    _, cls = np.unique(key, return_inverse=True)
    by = np.argsort(cls, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], np.diff(cls[by]) != 0)))
    nth = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    return np.sort(order[by[nth < most]])


def _split(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors by their length: rows of the table and a matrix."""
    column = table.column("vec").combine_chunks()
    column = column if isinstance(column, pa.ListArray) else pa.concat_arrays(column.chunks)
    size = np.diff(column.offsets.to_numpy())
    starts = column.offsets.to_numpy()[:-1]
    values = column.values.to_numpy(zero_copy_only=False)
    return {int(d): (rows, values[starts[rows][:, None] + np.arange(d)]) for d in np.unique(size) for rows in [np.flatnonzero(size == d)]}


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    column = table.column("id")
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy()


def neighbours(q: Block, c: Block, k: int) -> list[list[tuple]]:
    """A heap per query of its ``k`` nearest candidates as ``(score, known, -id)``, larger ones nearer."""
    heaps: list[list[tuple]] = [[] for _ in range(len(q))]
    best = np.full(len(q), -np.inf)
    for a in range(0, len(q), TILE_QUERIES):
        queries = slice(a, min(len(q), a + TILE_QUERIES))
        for b in range(0, len(c), TILE_CANDIDATES):
            i, j = survivors(q, c, queries, slice(b, min(len(c), b + TILE_CANDIDATES)), best, k)
            score = cosines(q, c, i, j)
            # At most k of a tile for each query.
            order = np.lexsort((c.ids[j], ~c.known[j], -score, i))
            firsts = np.flatnonzero(np.concatenate(([True], np.diff(i[order]) != 0))) if len(i) else np.zeros(0, int)
            nth = np.arange(len(order)) - np.repeat(firsts, np.diff(np.append(firsts, len(order))))
            order = order[nth < k]
            for query, s, known, name in zip(i[order].tolist(), score[order].tolist(), c.known[j[order]].tolist(), c.ids[j[order]].tolist()):
                heap, entry = heaps[query], (s, known, -name)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                if len(heap) == k:
                    best[query] = heap[0][0]
    return heaps


def _tiles(k: int):
    """One group of candidates against one of queries: the ``k + 1`` nearest of each query, itself included."""

    def work(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = {name: [] for name in TYPES}
        if candidates.num_rows and queries.num_rows:
            ids, known = _ids(candidates)
            matrices = _split(candidates)
            qids, qknown = _ids(queries)
            qrow, piece = queries.column("qrow").to_numpy(), queries.column("tile")[0].as_py()
            for d, (rows, asked) in _split(queries).items():
                if d not in matrices:
                    continue
                at, vectors = matrices[d]
                some = fewest_copies(vectors, np.lexsort((ids[at], ~known[at])), k + 1)
                c = Block(vectors[some], ids[at][some], known[at][some])
                q = Block(asked, qids[rows], qknown[rows], qrow[rows])
                itself = (q.square / (q.norm * q.norm)).tolist()
                for n, heap in enumerate(neighbours(q, c, k + 1)):
                    for nth, (s, there, minus) in enumerate(sorted(heap, reverse=True)):
                        out["qrow"].append(int(q.row[n]))
                        out["piece"].append(piece)
                        out["nth"].append(nth)
                        out["query_id"].append(int(q.ids[n]) if q.known[n] else None)
                        out["vec_id"].append(-minus if there else None)
                        out["score"].append(s)
                        out["own"].append(bool(there == q.known[n] and (not there or -minus == q.ids[n]) and s == itself[n]))
        return pa.table({name: pa.array(out[name], kind) for name, kind in TYPES.items()})

    return work


def _merged(k: int):
    """Merge the sorted lists of each query and leave the query's own row out."""

    def work(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*[table.column(c).to_pylist() for c in ("qrow", "piece", "nth", "score", "vec_id", "own", "query_id")]))
        lists: dict[int, dict[int, list]] = {}
        names = {}
        for qrow, piece, _, score, vec_id, own, query_id in rows:
            names[qrow] = query_id
            lists.setdefault(qrow, {}).setdefault(piece, []).append((-score, vec_id is None, vec_id or 0, own))
        out = []
        for qrow, pieces in lists.items():
            near, left_out = [], False
            for score, unknown, vec_id, own in islice(heapq.merge(*pieces.values()), k + 1):
                if own and not left_out:
                    left_out = True
                elif len(near) < k:
                    near.append((names[qrow], len(near) + 1, None if unknown else vec_id, -score))
            out += near
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(x, t) for n, x, t in zip(("query_id", "rank", "vec_id", "score"), columns, kinds)})

    return work


def nearest(vectors: DataFrame, asked: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that is ``asked``, the ``k`` other rows of largest cosine, nearest first."""
    spark = vectors.sparkSession
    base.prepare(spark)
    vec = F.col(f"`{vec_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"), F.coalesce(asked, F.lit(False)).alias("asked")).filter(usable(vec))
    queries = base.stored(rows.filter("asked").select("id", "vec", F.monotonically_increasing_id().alias("qrow")), "queries")
    width = 8 if "double" in vectors.schema[vec_col].dataType.simpleString() else 4
    n, total = rows.agg(F.count("*"), F.sum(F.size("vec"))).first()
    n_asked, total_asked = queries.agg(F.count("*"), F.sum(F.size("vec"))).first()
    if not n_asked:
        return spark.createDataFrame([], NEAREST)
    across = max(-(-total * width // CANDIDATE_BYTES), min(spark.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)))
    down = -(-total_asked * width // QUERY_BYTES)
    # Every group of candidates meets every group of queries: tile = group of queries * across + group of candidates.
    every = lambda of, n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(of)
    deal = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n))
    c = rows.select("id", "vec", deal(across).alias("a")).select("id", "vec", "a", every("d", down))
    q = queries.select("id", "vec", "qrow", F.pmod(F.xxhash64("qrow"), F.lit(down)).alias("d")).select("id", "vec", "qrow", "d", every("a", across))
    tile = (F.col("d") * across + F.col("a")).alias("tile")
    found = (
        c.select("id", "vec", tile).groupBy("tile")
        .cogroup(q.select("id", "vec", "qrow", tile).groupBy("tile"))
        .applyInArrow(base.trimmed(_tiles(k)), FOUND)
    )
    merges = max(1, n_asked * across * (k + 1) // ROWS_PER_MERGE)
    lists = found.withColumn("part", F.pmod(F.xxhash64("qrow"), F.lit(merges)))
    return lists.groupBy("part").applyInArrow(base.trimmed(_merged(k)), NEAREST)
