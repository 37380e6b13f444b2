"""In-batch dedup and change capture."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.filters import drop_incomplete
from skyledger.operators.joins import anti_seen
from skyledger.operators.windows import last_row
from skyledger.spec import DatasetSpec


@dataclass(frozen=True)
class Changes:
    """What one poll emits, and the state the next poll starts from."""

    emitted: DataFrame
    offset: DataFrame
    seen: DataFrame


def dedup_batch(df: DataFrame, key: Sequence[str], seq: str | Sequence[str]) -> DataFrame:
    """The last row per key by sequence."""
    order = [seq] if isinstance(seq, str) else list(seq)
    return last_row(df, list(key), order).select(*df.columns)


def changed_rows(
    batch: DataFrame, offset: DataFrame, seen: DataFrame, spec: DatasetSpec, scope: str = "dataset"
) -> DataFrame:
    """Rows of a poll that are new or changed.

    ``dataset`` scope keeps one watermark for all stations: rows after it are emitted, copies included; rows
    on it only when the station's fingerprint differs from the one in ``seen`` at the start of the poll;
    earlier rows never. ``offset`` has one row and one column ``offset``, ``seen`` has ``(key, _fp)``.

    ``station`` scope applies the same rules with a watermark per station; ``seen`` then holds
    ``(key, offset, _fp)`` and ``offset`` is not read.
    """
    rows = drop_incomplete(batch, [spec.ts, spec.key]).filter(F.col("_fp").isNotNull())
    ts = F.col(spec.ts)
    if scope == "dataset":
        mark = offset.select("offset").scalar()
        # Only rows on the watermark need the lookup; newer rows, the bulk, pass without a join.
        on_mark = anti_seen(rows.filter(ts == mark), seen, spec.key).select(*rows.columns)
        return rows.filter(ts > mark).unionByName(on_mark)
    if scope != "station":
        raise ValueError(f"unknown scope {scope!r}")
    state = seen.select(spec.key, F.col("offset").alias("_offset"), F.col("_fp").alias("_seen_fp"))
    changed = (ts == F.col("_offset")) & ~F.col("_fp").eqNullSafe(F.col("_seen_fp"))
    return (
        rows.join(state, spec.key, "left")
        .filter(F.col("_offset").isNull() | (ts > F.col("_offset")) | changed)
        .select(*rows.columns)
    )


def next_state(
    emitted: DataFrame, offset: DataFrame, seen: DataFrame, spec: DatasetSpec, scope: str = "dataset", seq: str = "_seq"
) -> tuple[DataFrame, DataFrame]:
    """Offset and fingerprints after a poll, from what it emitted and the state before it.

    The remembered rows join the emitted ones and rank before them, so one aggregate covers both an
    advanced watermark, which forgets them, and a standing one, which overlays them.
    """
    rank = lambda fresh, at: F.struct(F.lit(fresh).alias("fresh"), at.alias("at")).alias("_rank")
    none = F.lit(None).cast(emitted.schema[seq].dataType)
    fresh = emitted.select(spec.key, spec.ts, rank(1, F.col(seq)), "_fp")
    if scope == "station":
        known = seen.select(spec.key, F.col("offset").alias(spec.ts), rank(0, none), "_fp")
        after = (
            known.unionByName(fresh)
            .groupBy(spec.key)
            .agg(F.max(spec.ts).alias("offset"), F.max_by("_fp", F.struct(spec.ts, "_rank")).alias("_fp"))
        )
        return after.agg(F.max("offset").alias("offset")), after
    before = offset.select("offset")
    top = fresh.agg(F.max(spec.ts).alias("offset")).union(before).agg(F.max("offset").alias("offset"))
    known = seen.select(spec.key, before.scalar().alias(spec.ts), rank(0, none), "_fp")
    after = (
        known.unionByName(fresh)
        .filter(F.col(spec.ts) == top.scalar())
        .groupBy(spec.key)
        .agg(F.max_by("_fp", "_rank").alias("_fp"))
    )
    return top, after


def emit_changes(
    batch: DataFrame, offset: DataFrame, seen: DataFrame, spec: DatasetSpec, scope: str = "dataset", seq: str = "_seq"
) -> Changes:
    """``changed_rows`` and ``next_state`` as one lazy plan; a job stores the emitted rows in between."""
    emitted = changed_rows(batch, offset, seen, spec, scope)
    return Changes(emitted, *next_state(emitted, offset, seen, spec, scope, seq))


def upsert_dimension(dim: DataFrame, batch: DataFrame, key: str, update_cols: Sequence[str]) -> DataFrame:
    """Insert new keys whole; on known keys change only ``update_cols``, NULLs included."""
    old = dim.select(key, F.lit(True).alias("_old"), *[F.col(c).alias(f"_o_{c}") for c in dim.columns if c != key])
    new = batch.select(key, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in dim.columns if c != key])

    def settle(name: str) -> Column:
        first = "_new" if name in update_cols else "_old"
        newer, older = F.col(f"_n_{name}"), F.col(f"_o_{name}")
        chosen, fallback = (newer, older) if first == "_new" else (older, newer)
        return F.when(F.col(first), chosen).otherwise(fallback).alias(name)

    return old.join(new, key, "full_outer").select(
        *[F.col(c) if c == key else settle(c) for c in dim.columns]
    )
