"""What the operators share: scratch tables, batch sizes and Arrow columns as numpy arrays."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import work_dir

#: Rows and bytes of one Arrow batch sent to Python; a batch never holds much more text than this.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
#: A key with more than one in so many rows is joined by broadcast.
SHARE = 128
#: Text bytes that numpy works on at a time, whole documents at least.
CHUNK_BYTES = 1 << 18
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_libc = None


def prepare(spark: SparkSession) -> None:
    """Let workers find this package where the driver has it, and keep Arrow batches small, so that long texts
    don't add up in a Python worker."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def trim() -> None:
    """Give freed memory back to the system; a Python worker is kept for later tasks and would keep it, too."""
    global _libc
    if _libc is None:
        _libc = ctypes.CDLL(None)
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)
    pa.default_memory_pool().release_unused()


def trimmed(work: Callable) -> Callable:
    """The function of one or two arguments, with ``trim`` after every call."""

    def one(a):
        try:
            return work(a)
        finally:
            trim()

    def two(a, b):
        try:
            return work(a, b)
        finally:
            trim()

    return two if work.__code__.co_argcount == 2 else one


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, **cols: str) -> DataFrame:
    """The whole row as the struct ``row``, beside copies of the columns to work on under names of one's own: no column
    that the rows bring along can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(whole, *[F.col(f"`{source}`").alias(name) for name, source in cols.items()])


def look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which holds a key at most once; null where it doesn't. Rows should be stored.

    A key that many rows share isn't sent to one task: the fewer than SHARE keys with more than one in SHARE rows are
    named in the plan, and what the table says of them is broadcast.
    """
    total = rows.count()
    shared = rows.groupBy(key).count().filter(F.col(key).isNotNull() & (F.col("count") * SHARE > total))
    often = [r[0] for r in shared.select(key).collect()]
    if not often:
        return rows.join(table, key, "left")
    among = F.coalesce(F.col(key).isin(often), F.lit(False))
    most = rows.filter(among).join(F.broadcast(table.filter(F.col(key).isin(often))), key, "left")
    return most.unionByName(rows.filter(~among).join(table, key, "left"))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as ``(bytes, offsets)``; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if len(column) and buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about ``size`` bytes: ``(first, last, bytes, offsets)``."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def empty(**types: pa.DataType) -> pa.Table:
    """No rows of these columns."""
    return pa.table({name: pa.array([], kind) for name, kind in types.items()})


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < width:
        out = np.minimum(out[: -(width - span)], out[width - span :])
    return out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, …`` of each range, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - starts, counts)
