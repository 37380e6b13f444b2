"""Counts, coverage, cadence and counter arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.time import format_ts, instant, interval_seconds, time_bucket
from skyledger.operators.filters import last_interval, scan_range
from skyledger.operators.windows import block_window, carry_over, in_blocks, with_carried


def row_count(df: DataFrame, ts: str = "ts", since=None, until=None, name: str = "total_rows") -> DataFrame:
    return scan_range(df, ts, since, until).agg(F.count(F.lit(1)).alias(name))


def avg_recent(df: DataFrame, metric: str, duration="1 hour", as_of=None, ts: str = "ts") -> DataFrame:
    """One row: the average over the recent interval, NULL when it is empty."""
    return last_interval(df, ts, duration, as_of, strict=True).agg(F.avg(metric).alias(f"avg_{metric}"))


def distinct_stations(
    df: DataFrame, key: str = "fiwareid", snapshot: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """Number of distinct stations, empty ids left out, per snapshot or overall."""
    named = F.when(F.col(key) != "", F.col(key))
    count = F.approx_count_distinct(named) if approx else F.count_distinct(named)
    return df.groupBy(*snapshot).agg(count.alias("stations"))


def snapshot_tick(df: DataFrame, dataset: str, ts: str = "ts") -> DataFrame:
    """Per snapshot: the greatest tick, how many distinct ticks it mixes, and a flag when more than one."""
    ticks = df.filter(F.col(ts).isNotNull()).groupBy(dataset, ts).agg(F.count(F.lit(1)).alias("_rows"))
    return ticks.groupBy(dataset).agg(
        F.max(ts).alias("max_tick"),
        F.count(F.lit(1)).alias("tick_count"),
        F.sum("_rows").alias("row_count"),
        (F.count(F.lit(1)) > 1).alias("mixed"),
    )


def snapshot_ticks(df: DataFrame, dataset: str, ts: str = "ts") -> DataFrame:
    """The distinct ticks of each snapshot, one per row."""
    return df.filter(F.col(ts).isNotNull()).select(dataset, F.col(ts).alias("tick")).distinct()


def max_ts_or_default(df: DataFrame, ts: str = "ts", default: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The newest instant as wire text, or the default for an empty table."""
    return df.agg(F.coalesce(format_ts(F.max(ts)), F.lit(default)).alias("max_ts"))


def latest_ts(df: DataFrame, ts: str = "ts", dataset: str | None = None) -> DataFrame:
    return df.groupBy(*([dataset] if dataset else [])).agg(F.max(ts).alias("last_ts"))


def metric_coverage(df: DataFrame, metrics: Sequence[str], key: str | None = None) -> DataFrame:
    """Per metric: rows (or stations, given a key) with a value, the total, and the percentage."""
    if key:
        df = df.groupBy(key).agg(*[F.max(F.col(m)).alias(m) for m in metrics])
    totals = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(m).alias(m) for m in metrics])
    long = totals.unpivot(["total"], list(metrics), "metric", "with_value")
    percent = F.when(F.col("total") > 0, F.col("with_value") * F.lit(100.0) / F.col("total"))
    return long.select("metric", "with_value", "total", percent.alias("percent"))


def coverage_matrix(df: DataFrame, metrics: Sequence[str], key: str = "fiwareid") -> DataFrame:
    """Station by metric: whether the station ever reports it, in station order."""
    return df.groupBy(key).agg(*[(F.count(m) > 0).alias(m) for m in metrics]).orderBy(key)


def gap_summary(gaps: DataFrame, dataset: str | None = None, gap: str = "gap_hours") -> DataFrame:
    return gaps.groupBy(*([dataset] if dataset else [])).agg(
        F.count(gap).alias("advances"),
        F.avg(gap).alias("mean_hours"),
        F.min(gap).alias("min_hours"),
        F.max(gap).alias("max_hours"),
    )


def count_between(
    df: DataFrame, dataset: str, ts: str, start, end, name: str = "row_count", expected: DataFrame | None = None
) -> DataFrame:
    """Rows per dataset in the half-open range of whole UTC days; only that range is read.

    Datasets listed in ``expected`` get a row of 0 if they have none.
    """
    day0, day1 = F.date_trunc("day", instant(start)), F.date_trunc("day", instant(end))
    counts = df.filter((F.col(ts) >= day0) & (F.col(ts) < day1)).groupBy(dataset).agg(F.count(F.lit(1)).alias(name))
    if expected is None:
        return counts
    listed = expected.select(F.col(dataset).alias("_dataset")).distinct()
    joined = listed.join(counts, F.col("_dataset").eqNullSafe(F.col(dataset)), "left")
    return joined.select(F.col("_dataset").alias(dataset), F.coalesce(name, F.lit(0).cast("long")).alias(name))


def active_datasets(df: DataFrame, dataset: str, ts: str, as_of=None, days: int = 60) -> DataFrame:
    """Datasets with rows in the last days, busiest first."""
    now = instant(as_of)
    start = F.date_trunc("day", now) - F.expr(f"INTERVAL {days} DAYS")
    ranged = df.filter((F.col(ts) >= start) & (F.col(ts) < F.date_trunc("day", now)))
    return (
        ranged.groupBy(dataset)
        .agg(F.count(F.lit(1)).alias(f"last_{days}_days"))
        .orderBy(F.desc(f"last_{days}_days"), dataset)
    )


def delivery_stats(events: DataFrame, failed: Column, ts: str = "ts", window: str = "60 seconds") -> DataFrame:
    """Deliveries, failures and their ratio per tumbling window, windows counted from the bucket origin."""
    totals = events.groupBy(time_bucket(window, ts).alias("window_start")).agg(
        F.count_if(~failed).alias("success"), F.count_if(failed).alias("failure")
    )
    total = F.col("success") + F.col("failure")
    return totals.select(
        "window_start",
        "success",
        "failure",
        total.alias("total"),
        F.coalesce(F.try_divide(F.col("failure").cast("double"), total), F.lit(0.0)).alias("failure_ratio"),
    )


def counter_increase(
    df: DataFrame,
    range_width,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    name: str = "increase",
    block: str = "1 hour",
) -> DataFrame:
    """Growth of a counter over the trailing range at each sample; a drop in value is a restart from zero.

    Counts the steps between samples inside ``(ts - range, ts]``, without extrapolation to the range edges. Series are
    cut into blocks whatever the range: one segmented scan gives every sample the growth since the series began, a second
    finds for each sample the first one after the open start of its range. Samples without an instant are left out.
    """
    span = interval_seconds(range_width) * 1_000_000
    width = interval_seconds(block) * 1_000_000
    keys = list(series)
    at = F.unix_micros(ts)
    home = lambda t: F.floor(t / F.lit(width)).cast("long")
    step = lambda old, new: F.when(new < old, new).otherwise(new - old)
    samples = in_blocks(df.filter(F.col(ts).isNotNull()).select(*keys, at.alias("_at"), value), keys, home(F.col("_at")))
    # Blocks hold whole instants, so equal ones meet without another shuffle.
    samples = samples.groupBy(*keys, "_block", "_at").agg(F.max(value).alias(value))
    before = F.lag(value).over(Window.partitionBy(*keys, "_block").orderBy("_at"))
    steps = samples.withColumn("_step", F.coalesce(step(before, F.col(value)), F.lit(0)).cast("double"))

    def carry(blocks: DataFrame, earlier) -> DataFrame:
        into = F.coalesce(step(F.last("_last", ignorenulls=True).over(earlier), F.col("_first")), F.lit(0)).cast("double")
        began = blocks.withColumn("_into", into)
        so_far = F.sum(F.col("_into") + F.col("_sum")).over(earlier)
        return began.select(*keys, "_block", (F.coalesce(so_far, F.lit(0.0)) + F.col("_into")).alias("_start"))

    tail = [F.sum("_step").alias("_sum"), F.min_by(value, "_at").alias("_first"), F.max_by(value, "_at").alias("_last")]
    # Growth up to the first sample of every block.
    starts = carry_over(steps, keys, tail, carry)
    run = F.sum("_step").over(block_window(keys, "_at", Window.unboundedPreceding, 0))
    total = (F.col("_start") + F.col("_run")).alias("_total")
    grown = with_carried(steps.withColumn("_run", run), starts, keys).select(*keys, "_at", value, total)
    # Each sample stands in the block of its own time, and asks in the block of its range's start for the next sample there.
    ask = F.struct((F.col("_at") - F.lit(span)).alias("_time"), F.lit(True).alias("_asks"))
    stand = F.struct(F.col("_at").alias("_time"), F.lit(False).alias("_asks"))
    both = grown.select("*", F.inline(F.array(ask, stand))).withColumn("_block", home(F.col("_time")))
    # Backwards in time; of equal times the asking one comes first, as its range is open there.
    back = Window.partitionBy(*keys, "_block").orderBy(F.desc("_time"), F.desc("_asks")).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.last(F.when(~F.col("_asks"), F.col("_total")), ignorenulls=True).over(back)
    found = both.withColumn("_origin", seen).filter("_asks")
    # Where a block holds no sample after the ask, the next block's first one counts. Asks of one block go to two at most.
    reach = [home(F.col("_block") * width + edge - span) for edge in (0, width - 1)]
    asked = starts.select(*keys, F.explode(F.array_distinct(F.array(*reach))).alias("_block"))
    later = Window.partitionBy(*keys).orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    blocks = starts.unionByName(asked, allowMissingColumns=True).groupBy(*keys, "_block").agg(F.max("_start").alias("_start"))
    nexts = blocks.select(*keys, "_block", F.first("_start", ignorenulls=True).over(later).alias("_next"))
    return with_carried(found, nexts, keys).select(
        *keys, F.timestamp_micros("_at").cast(df.schema[ts].dataType).alias(ts), value, (F.col("_total") - F.coalesce("_origin", "_next")).cast("double").alias(name)
    )


def with_silent(grown: DataFrame, expected: DataFrame, series: Sequence[str], at, ts: str = "ts", name: str = "increase") -> DataFrame:
    """Growth rows, and one of 0 at the instant ``at`` for every expected series that has none."""
    known = grown.select(*series).distinct().withColumnsRenamed({c: f"_s_{c}" for c in series})
    same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in series]
    silent = expected.select(*series).distinct().join(known, same, "left_anti")
    zero = silent.withColumns({ts: instant(at), name: F.lit(0.0)})
    return grown.unionByName(zero, allowMissingColumns=True)


def counter_rate(df: DataFrame, range_width, series: Sequence[str], **names) -> DataFrame:
    """Per-second growth over the trailing range."""
    grown = counter_increase(df, range_width, series, name="increase", **names)
    return grown.withColumn("rate", F.col("increase") / F.lit(float(interval_seconds(range_width)))).drop("increase")
