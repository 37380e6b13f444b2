"""Time-bucket rollups and the series the dashboards draw from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.numeric import circular_mean_deg, round_numeric
from skyledger.functions.time import time_bucket
from skyledger.operators.filters import calendar_filter, last_interval
from skyledger.spec import DatasetSpec

BUCKET_NAMES = {"1 day": "bucket_day", "7 days": "bucket_week"}


def rollup_columns(spec: DatasetSpec) -> list[Column]:
    kinds = {"avg": F.avg, "max": F.max, "circular": circular_mean_deg}
    return [kinds[kind](source).alias(out) for out, kind, source in spec.rollup]


def rollup(df: DataFrame, spec: DatasetSpec, width: str, name: str | None = None) -> DataFrame:
    """Averages, maxima and mean directions per station and bucket; partial aggregation, one shuffle."""
    bucket = name or BUCKET_NAMES.get(width, "bucket")
    return df.groupBy(F.col(spec.key), time_bucket(width, spec.ts).alias(bucket)).agg(*rollup_columns(spec))


# What is kept of a bucket so that buckets can be merged: the parts of each kind of column, and the column made from them.
PARTS = {"avg": ("sum", "n"), "max": ("max",), "circular": ("sin", "cos", "n")}


def _part(out: str, name: str) -> str:
    return f"{out}__{name}"


def state_schema(spec: DatasetSpec, bucket: str) -> T.StructType:
    fields = [(_part(out, p), T.LongType() if p == "n" else T.DoubleType()) for out, kind, _ in spec.rollup for p in PARTS[kind]]
    return T.StructType(
        [T.StructField(spec.key, T.StringType()), T.StructField(bucket, T.TimestampType()), *[T.StructField(n, t) for n, t in fields]]
    )


def rollup_states(df: DataFrame, spec: DatasetSpec, width: str, name: str | None = None) -> DataFrame:
    """Sums, counts, maxima and sums of sines and cosines per station and bucket, which merge into wider buckets."""
    bucket, found = name or BUCKET_NAMES.get(width, "bucket"), []
    for out, kind, source in spec.rollup:
        angle = F.radians(source)
        every = {"sum": F.sum(source), "n": F.count(source), "max": F.max(source), "sin": F.sum(F.sin(angle)), "cos": F.sum(F.cos(angle))}
        found += [every[p].alias(_part(out, p)) for p in PARTS[kind]]
    return df.groupBy(F.col(spec.key), time_bucket(width, spec.ts).alias(bucket)).agg(*found)


def merge_states(states: DataFrame, spec: DatasetSpec, bucket: str, width: str) -> DataFrame:
    """States of narrower buckets, whose width divides ``width``, as states of buckets of that width."""
    name = BUCKET_NAMES.get(width, "bucket")
    columns = [_part(out, p) for out, kind, _ in spec.rollup for p in PARTS[kind]]
    merged = [(F.max(c) if c.endswith("__max") else F.sum(c)).alias(c) for c in columns]
    return states.groupBy(F.col(spec.key), time_bucket(width, bucket).alias(name)).agg(*merged)


def finish_states(states: DataFrame, spec: DatasetSpec, bucket: str) -> DataFrame:
    """The rollup columns of merged states."""

    def made(out: str, kind: str) -> Column:
        part = lambda p: F.col(_part(out, p))
        if kind == "max":
            return part("max")
        if kind == "avg":
            return F.when(part("n") > 0, part("sum") / part("n"))
        return F.when(part("n") > 0, F.degrees(F.atan2(part("sin") / part("n"), part("cos") / part("n"))))

    return states.select(spec.key, bucket, *[made(out, kind).alias(out) for out, kind, _ in spec.rollup])


def hourly_trend(
    df: DataFrame, metrics: dict[str, str], as_of=None, ts: str = "ts", duration: str = "24 hours"
) -> DataFrame:
    """Hourly averages over all stations for the last day; ``metrics`` maps output to input names."""
    recent = last_interval(df, ts, duration, as_of, strict=True)
    return (
        recent.groupBy(time_bucket("1 hour", ts).alias("hour"))
        .agg(*[F.avg(source).alias(out) for out, source in metrics.items()])
        .orderBy("hour")
    )


def climatology(
    daily: DataFrame,
    month: int,
    day_from: int,
    day_to: int,
    metrics: Sequence[str],
    key: str = "fiwareid",
    bucket: str = "bucket_day",
    day_name: str = "day_of_month",
    circular: Sequence[str] = (),
) -> DataFrame:
    """Means of daily rollups for the same calendar days of all years, to two decimals.

    Directions are averaged arithmetically, as the dashboards do, unless named in ``circular``.
    """

    def mean(name: str) -> Column:
        return round_numeric(circular_mean_deg(name) if name in circular else F.avg(name), 2).alias(name)

    return (
        calendar_filter(daily, bucket, month, day_from, day_to)
        .groupBy(F.dayofmonth(bucket).alias(day_name), F.col(key))
        .agg(*[mean(m) for m in metrics], F.count(F.lit(1)).alias("years_of_data"))
        .orderBy(day_name, key)
    )


def daily_recent(
    daily: DataFrame, days: int = 7, as_of=None, cols: Sequence[str] | None = None, key: str = "fiwareid"
) -> DataFrame:
    """Daily rollup rows of the last days, newest first."""
    recent = last_interval(daily, "bucket_day", f"{days} days", as_of, strict=True)
    wanted = ["bucket_day", key, *(cols or [c for c in daily.columns if c not in ("bucket_day", key)])]
    return recent.select(*wanted).orderBy(F.desc("bucket_day"), key)


def long_series(df: DataFrame, metric: str, duration, as_of=None, key: str = "fiwareid", ts: str = "ts") -> DataFrame:
    """``time, metric, value`` rows for one metric over a recent interval, in time order."""
    recent = last_interval(df, ts, duration, as_of).filter(F.col(metric).isNotNull())
    return recent.select(F.col(ts).alias("time"), F.col(key).alias("metric"), F.col(metric).alias("value")).orderBy(
        "time", "metric"
    )


def wide_series(series: DataFrame, names: Sequence[str]) -> DataFrame:
    """A long series with one column per listed name; the list keeps the width known at plan time."""
    return series.groupBy("time").pivot("metric", list(names)).agg(F.first("value", ignorenulls=True)).orderBy("time")
