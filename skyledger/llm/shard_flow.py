"""Minimum-cost-flow resharding.

Rows lie in old shards and in blocks within them, ``blocks`` a shard by a hash of their id and text. Old shard sizes and new
capacities are a transport problem: staying in the shard of the same number is free, every other move costs its bytes.
``transfers`` solves it exactly by successive shortest paths on a graph of shards, whose size doesn't depend on the rows.
``assign_blocks`` sends whole blocks along the flows, largest first, so what doesn't fit exactly is small. ``place`` numbers the rows of every shard without a gap from block offsets and ranks inside blocks, and
``rewrite`` writes the files of shards that a transfer touches; the others stay as they are.

Law ``bytes``: new capacities are equal, so sizes differ by about a block. Sizes count the UTF-8 bytes of the text (null:
none) plus ``OVERHEAD``. A null old shard is -1, which no new shard is, so its rows move. Rows without an id are dealt by their texts like others; repeated rows
count each and lie next to one another, in one block; an empty table gives an empty one and no transfer.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm import base

OVERHEAD, BLOCKS = 16, 4096


@dataclass(frozen=True)
class Transfer:
    old: int
    new: int
    bytes: int


def row_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def equal_capacities(total: int, shards: int) -> list[int]:
    """Sizes that differ by one byte at most."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def transfers(old: dict[int, int], capacity: list[int], cost=lambda i, j: 0 if i == j else 1) -> list[Transfer]:
    """Flows of least total cost that empty every old shard and fill every new one; sizes must add up.

    Successive shortest paths with potentials: each round sends as much as possible along a cheapest path from shards
    with bytes left to shards with room, so every round is optimal for what it has sent.
    """
    if sum(old.values()) != sum(capacity):
        raise ValueError("old sizes and new capacities differ in total")
    sources = sorted(old)
    n, m = len(sources), len(capacity)
    price = np.array([[cost(i, j) for j in range(m)] for i in sources], float).reshape(n, m)
    flow = np.zeros((n, m), np.int64)
    left, room = np.array([old[i] for i in sources], np.int64), np.array(capacity, np.int64)
    pot = np.zeros(n + m)
    while left.sum() > 0:
        dist, back, done = np.full(n + m, np.inf), np.full(n + m, -1), np.zeros(n + m, bool)
        queue = [(0.0, int(i)) for i in np.flatnonzero(left > 0)]
        for _, i in queue:
            dist[i] = 0
        heapq.heapify(queue)
        while queue:
            d, u = heapq.heappop(queue)
            if done[u]:
                continue
            done[u] = True
            if u < n:
                reach, step = np.arange(n, n + m), price[u] + pot[u] - pot[n:]
            else:
                senders = np.flatnonzero(flow[:, u - n] > 0)
                reach, step = senders, pot[u] - price[senders, u - n] - pot[senders]
            for v, w in zip(reach.tolist(), np.maximum(step, 0).tolist()):
                if d + w < dist[v] - 1e-12:
                    dist[v], back[v] = d + w, u
                    heapq.heappush(queue, (d + w, v))
        ends = np.flatnonzero(room > 0) + n
        end = int(ends[np.argmin(dist[ends])])
        pot += np.minimum(dist, dist[end])
        path = [end]
        while back[path[-1]] >= 0:
            path.append(int(back[path[-1]]))
        path.reverse()
        sent = min(int(left[path[0]]), int(room[end - n]), *[int(flow[v, u - n]) for u, v in zip(path, path[1:]) if u >= n], 2**62)
        for u, v in zip(path, path[1:]):
            if u < n:
                flow[u, v - n] += sent
            else:
                flow[v, u - n] -= sent
        left[path[0]] -= sent
        room[end - n] -= sent
    return [Transfer(sources[i], int(j), int(flow[i, j])) for i, j in zip(*np.nonzero(flow))]


def assign_blocks(blocks: list[tuple[int, int, int]], moves: list[Transfer], capacity: list[int]) -> dict[tuple[int, int], int]:
    """New shard of each block ``(old, block, bytes)``: largest first, blocks stay while their shard's own flow holds
    them, then go where a flow of their shard still has room for them, at last to the emptiest shard."""
    flow: dict[int, dict[int, int]] = {}
    for t in moves:
        flow.setdefault(t.old, {})[t.new] = t.bytes
    room, shard, loose = list(capacity), {}, []
    for old, block, size in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        if flow.get(old, {}).get(old, 0) >= size:
            flow[old][old] -= size
            room[old] -= size
            shard[old, block] = old
        else:
            loose.append((old, block, size))
    emptiest = [(-r, j) for j, r in enumerate(room)]
    heapq.heapify(emptiest)
    for old, block, size in loose:
        flows = flow[old]
        new = max(flows, key=lambda j: (flows[j], -j))
        if flows[new] >= size and room[new] >= size:
            flows[new] -= size
        else:
            while -emptiest[0][0] != room[emptiest[0][1]]:  # out of date
                heapq.heapreplace(emptiest, (-room[emptiest[0][1]], emptiest[0][1]))
            new = emptiest[0][1]
        room[new] -= size
        shard[old, block] = new
    return shard


def plan_blocks(sizes: DataFrame, shards: int, capacity: list[int] | None = None) -> tuple[DataFrame, list[Transfer]]:
    """New shard of every block ``(old, block, bytes, rows)``, with the number of rows before it there.

    The table of blocks reaches the driver; it has ``blocks`` rows an old shard at most, however many rows there are.
    """
    table = sorted((r["old"], r["block"], r["bytes"], r["rows"]) for r in sizes.collect())
    totals: dict[int, int] = {}
    for old, _, size, _ in table:
        totals[old] = totals.get(old, 0) + size
    capacity = capacity or equal_capacities(sum(totals.values()), shards)
    moves = transfers(totals, capacity)
    shard = assign_blocks([t[:3] for t in table], moves, capacity)
    filled, plan, moved = [0] * len(capacity), [], {}
    for old, block, size, rows in table:
        new = shard[old, block]
        plan.append((old, block, new, filled[new]))
        filled[new] += rows
        moved[old, new] = moved.get((old, new), 0) + size
    columns = [list(c) for c in zip(*plan)]
    frame = sizes.sparkSession.createDataFrame(
        pa.table({"old": pa.array(columns[0], pa.int64()), "block": pa.array(columns[1], pa.int32()), "shard": pa.array(columns[2], pa.int32()), "first": pa.array(columns[3], pa.int64())})
    )
    return frame, [Transfer(i, j, n) for (i, j), n in sorted(moved.items())]


def place(
    docs: DataFrame, old: Column, shards: int, id_col: str = "doc_id", text_col: str = "text", capacity: list[int] | None = None,
    blocks: int = BLOCKS,
) -> tuple[DataFrame, list[Transfer]]:
    """The columns of ``docs`` with ``_old``, ``_shard`` and ``_slot``, which replace columns of these names, and the
    transfers."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    id_, text = F.col("id"), F.col("text")
    named = docs.select(
        whole, F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(old.cast("long"), F.lit(-1)).alias("old"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(blocks)).cast("int").alias("block"),
    )
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("_old", "_shard", "_slot")]
    sizes = base.stored(
        named.groupBy("old", "block").agg(F.sum(row_size(text)).alias("bytes"), F.count("*").alias("rows")), "blocks"
    )
    if sizes.isEmpty():
        return named.select(*kept, F.col("old").alias("_old"), F.lit(0).alias("_shard"), F.lit(0).cast("long").alias("_slot")), []
    plan, moves = plan_blocks(sizes, shards, capacity)
    inside = Window.partitionBy("old", "block").orderBy(id_, F.xxhash64(text))
    ranked = named.withColumn("rank", F.row_number().over(inside) - 1).drop("id", "text")
    out = ranked.join(plan, ["old", "block"])
    return out.select(*kept, F.col("old").alias("_old"), F.col("shard").alias("_shard"), (F.col("first") + F.col("rank")).alias("_slot")), moves


def affected(moves: list[Transfer]) -> set[int]:
    """Shards that lose or gain rows."""
    return {x for t in moves if t.old != t.new for x in (t.old, t.new)}


def rewrite(placed: DataFrame, path: str, only: set[int] | None = None) -> None:
    """Write ``_shard=…`` folders for the shards in ``only`` (all without it), rows by slot within a file."""
    rows = placed if only is None else placed.filter(F.col("_shard").isin(sorted(only)))
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("_shard").parquet(path)


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)
