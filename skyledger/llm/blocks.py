"""Counts of hashed keys over a whole corpus at a few bytes a key.

Documents are dealt into blocks of some megabytes by a hash of their id and text, so that rows without an id, or of one id with
many texts, are spread as well. A block sends its distinct keys, sorted
and as small differences, to buckets of the key space; a bucket answers each block with one value a key, in the
same order. A block therefore learns what the whole corpus holds of its own keys without either side being held
in one place, and a key that occurs everywhere arrives at most once from each block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base

#: Text bytes of a block, and keys of a bucket, on average.
BLOCK_BYTES, BUCKET_KEYS = 4 << 20, 1 << 20
BLOB = "blk long, bucket long, keys binary, vals binary"


def no_blobs() -> pa.Table:
    return base.empty(blk=pa.int64(), bucket=pa.int64(), keys=pa.binary(), vals=pa.binary())


def in_blocks(
    docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, carry: Sequence[str] = ()
) -> tuple[DataFrame, int, int]:
    """``(doc_id, text, blk)`` with the number of blocks and of text bytes; columns to carry go into a struct ``rest``."""
    rest = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest")] if carry else []
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *rest)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    return rows.withColumn("blk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))), n, total


def bucket_bits(keys: float) -> int:
    """Buckets are powers of two, about BUCKET_KEYS each."""
    return max(0, int(np.ceil(np.log2(max(1.0, keys / BUCKET_KEYS)))))


def pack(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as differences in as few bytes as the largest needs; the first byte holds that number."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    raw = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, width)
    steps = np.zeros((len(raw), 8), np.uint8)
    steps[:, :width] = raw
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def send(blk: int, keys: np.ndarray, vals: np.ndarray, bits: int, kept_bits: int = 64) -> pa.RecordBatch:
    """Blobs of one block: sorted distinct keys cut by their leading ``bits``, with a value each."""
    if bits:
        cuts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    else:
        cuts = np.zeros(1, np.int64)
    ends = np.append(cuts[1:], len(keys))
    used = np.flatnonzero(ends > cuts)
    drop, mask = np.uint64(64 - kept_bits), np.uint64((1 << (64 - bits)) - 1)
    rest = (keys & mask) >> drop
    return pa.record_batch(
        [
            pa.array(np.full(len(used), blk, np.int64)),
            pa.array(used.astype(np.int64)),
            pa.array([pack(rest[cuts[i] : ends[i]]) for i in used], pa.binary()),
            pa.array([vals[cuts[i] : ends[i]].tobytes() for i in used], pa.binary()),
        ],
        names=["blk", "bucket", "keys", "vals"],
    )


def distinct_keys(keys: np.ndarray, bits_kept: int) -> np.ndarray:
    """Keys cut to their leading bits, sorted and distinct."""
    drop = np.uint64(64 - bits_kept)
    return np.unique((keys >> drop) << drop)


def answer(judge: Callable[[np.ndarray, np.ndarray, int], np.ndarray], dtype: str, batches: pa.Table) -> pa.Table:
    """Merge the blobs of a bucket and give each block its values: ``judge(group_of_key, vals, n_groups)``."""
    blks = batches.column("blk").to_numpy()
    keys = [unpack(b) for b in batches.column("keys").to_pylist()]
    vals = [np.frombuffer(v, dtype) for v in batches.column("vals").to_pylist()]
    sizes = np.array([len(k) for k in keys])
    _, group = np.unique(np.concatenate(keys), return_inverse=True)
    said = judge(group, np.concatenate(vals), int(group.max()) + 1 if len(group) else 0)
    ends = np.cumsum(sizes)
    return pa.table(
        {
            "blk": pa.array(blks),
            "bucket": batches.column("bucket"),
            "keys": pa.array([b""] * len(blks), pa.binary()),
            "vals": pa.array([said[e - s : e].tobytes() for s, e in zip(sizes, ends)], pa.binary()),
        }
    )


def told(answers: pa.Table, dtype: str) -> np.ndarray:
    """A block's answers in the order of its sorted distinct keys."""
    order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
    parts = answers.column("vals").to_pylist()
    return np.concatenate([np.frombuffer(parts[i], dtype) for i in order]) if len(order) else np.zeros(0, dtype)


def total_count(group: np.ndarray, vals: np.ndarray, n: int) -> np.ndarray:
    """Occurrences of each key in all blocks, up to 255."""
    return np.minimum(np.bincount(group, vals, n), 255).astype(np.uint8)[group]
