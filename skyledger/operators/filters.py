"""Row filters. Each is a plain predicate, so it reaches the file scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.time import as_instant, before, chunk_start


def scan_range(
    df: DataFrame,
    ts: str = "ts",
    since: Column | datetime | str | None = None,
    until: Column | datetime | str | None = None,
) -> DataFrame:
    """Rows in ``[since, until)``; a ``chunk_start`` partition column, where present, is pruned too."""
    if since is not None:
        at = as_instant(since)
        df = df.filter(F.col(ts) >= at)
        if "chunk_start" in df.columns:
            df = df.filter(F.col("chunk_start") >= chunk_start(at))
    if until is not None:
        at = as_instant(until)
        df = df.filter(F.col(ts) < at)
        if "chunk_start" in df.columns:
            df = df.filter(F.col("chunk_start") <= at.cast("date"))
    return df


def last_interval(df: DataFrame, ts: str, duration, as_of=None, strict: bool = False) -> DataFrame:
    """Rows newer than ``as_of - duration``: ``>`` when strict, else ``>=``."""
    bound = before(as_of, duration)
    recent = df.filter(F.col(ts) > bound if strict else F.col(ts) >= bound)
    if "chunk_start" in df.columns:
        recent = recent.filter(F.col("chunk_start") >= chunk_start(bound))
    return recent


def not_null(df: DataFrame, metric: str) -> DataFrame:
    return df.filter(F.col(metric).isNotNull())


def require_metric(df: DataFrame, metric: str) -> DataFrame:
    """Drop rows without the metric, whatever else they hold."""
    return not_null(df, metric)


def station_eq(df: DataFrame, station: str, key: str = "fiwareid") -> DataFrame:
    return df.filter(F.col(key) == station)


def station_like(df: DataFrame, pattern: str, key: str = "fiwareid") -> DataFrame:
    """Case-sensitive SQL pattern match."""
    return df.filter(F.col(key).like(pattern))


def contains_ci(df: DataFrame, field: str | None, pattern: str | None) -> DataFrame:
    """Case-insensitive substring test on the value as text; without a field or pattern nothing is filtered."""
    if not field or not pattern:
        return df
    return df.filter(F.contains(F.lower(F.col(field).cast("string")), F.lower(F.lit(pattern))))


def calendar_filter(df: DataFrame, ts: str, month: int, day_from: int, day_to: int) -> DataFrame:
    """The same days of one month in every year."""
    return df.filter((F.month(ts) == month) & F.dayofmonth(ts).between(day_from, day_to))


def id_range(df: DataFrame, col: str, lo: int, hi: int, members: Iterable[int] | None = None) -> DataFrame:
    """Ids in ``[lo, hi]`` and, where given, in the exact set."""
    ranged = df.filter(F.col(col).between(lo, hi))
    return ranged if members is None else ranged.filter(F.col(col).isin(list(members)))


def drop_incomplete(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows whose columns are all present and, for text, not empty."""
    for name in cols:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        df = df.filter(F.col(name) != "" if is_text else F.col(name).isNotNull())
    return df
