"""Orderings, top-k, and unions of datasets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.spec import AIR, WEATHER


def latest_n(
    df: DataFrame, ts: str = "ts", n: int = 5, cols: Sequence[str] = (), station: str | None = None, key: str = "fiwareid"
) -> DataFrame:
    """The newest ``n`` rows, ties by station; Spark keeps ``n`` rows per task."""
    rows = df.filter(F.col(key) == station) if station else df
    wanted = list(cols) or rows.columns
    return rows.select(*dict.fromkeys([ts, key, *wanted])).orderBy(F.desc(ts), key).limit(n)


def sort_nulls_last(df: DataFrame, col: str = "objectid", ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(col), *ties)


def order_by_ts(df: DataFrame, ts: str = "ts", ties: Sequence[str] = ("fiwareid",)) -> DataFrame:
    """Global time order; tie columns let a crowded instant spread over range partitions."""
    return df.orderBy(ts, *ties)


def distinct_ids_union(*dfs: DataFrame, col: str = "dataset_id") -> DataFrame:
    """Sorted set-union of the ids of all inputs."""
    return reduce(DataFrame.unionByName, [df.select(col) for df in dfs]).distinct().orderBy(col)


def both_datasets(air: DataFrame, weather: DataFrame) -> DataFrame:
    """Air and weather rows in one frame, labelled, with NULL for the other's columns."""
    return air.withColumn("dataset", F.lit(AIR.name)).unionByName(
        weather.withColumn("dataset", F.lit(WEATHER.name)), allowMissingColumns=True
    )
