"""Latest rows and running state.

Ordered work never puts a whole series in one task. ``last_row`` and ``last_not_null`` are combinable
aggregates. The others are segmented scans: ``in_blocks`` deals a series into blocks by one shuffle, windows see the
rows of one block only, and ``carry_over`` sums each block up in a row, scans those few rows per series and hands
every block what came before it, all carried values at once. Blocks and their sums read the same shuffle, so a frame
that holds no more columns than the scan needs is read once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from skyledger.functions.time import interval_seconds

FIXED_WIDTH = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` per key, NULLs included.

    With one fixed-width order column that is unique per key and fixed-width values, every column gets its
    own ``max_by`` and Spark can hash-aggregate; otherwise one struct is carried. Both combine before the
    shuffle, so a key with a huge share of the rows leaves each task as a single row.
    """
    keep = [c for c in (cols or df.columns) if c not in keys]
    if len(order) == 1 and all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in [*keep, *order]):
        return df.groupBy(*keys).agg(*[F.max_by(c, order[0]).alias(c) for c in keep])
    ranking = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*keep), ranking).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in keep])
    )


def latest_per_station(
    df: DataFrame, key: str = "fiwareid", ts: str = "ts", cols: Sequence[str] | None = None
) -> DataFrame:
    """The newest whole row of each station.

    Text columns turn the aggregate into a sort of its input. With any of them, a hash aggregate over two
    narrow columns first finds every station's newest instant, and only rows at it are aggregated whole.
    A station without any instant has one row of NULLs, whatever the types.
    """
    wanted = [c for c in (cols or df.columns) if c not in (key, ts)]
    rows = df.select(key, ts, *wanted)
    if not all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in wanted):
        newest = df.groupBy(key).agg(F.max(ts).alias("_newest")).withColumnRenamed(key, "_station")
        match = [F.col(key).eqNullSafe(F.col("_station")), F.col(ts) == F.col("_newest")]
        at_it = last_row(rows.join(newest, match, "left_semi"), [key], [ts]).select(key, ts, *wanted)
        types = {c: df.schema[c].dataType for c in wanted}
        silent = newest.filter(F.col("_newest").isNull()).select(
            F.col("_station").alias(key), F.col("_newest").alias(ts), *[F.lit(None).cast(t).alias(c) for c, t in types.items()]
        )
        return at_it.unionByName(silent)
    return last_row(rows, [key], [ts]).select(key, ts, *wanted)


def last_not_null(df: DataFrame, metric: str, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """The newest value that is not NULL."""
    return df.filter(F.col(metric).isNotNull()).groupBy(*keys).agg(
        F.max_by(metric, ts).alias(metric), F.max(ts).alias(ts)
    )


def time_block(order: Column | str, width: int | str = "1 day") -> Column:
    """Block number of an instant."""
    at = F.col(order) if isinstance(order, str) else order
    return F.floor(F.unix_seconds(at) / F.lit(interval_seconds(width))).cast("long")


def number_block(order: Column | str, size: int = 4096) -> Column:
    """Block number of an integer sequence."""
    at = F.col(order) if isinstance(order, str) else order
    return F.floor(at / F.lit(size)).cast("long")


def in_blocks(df: DataFrame, keys: Sequence[str], block: Column) -> DataFrame:
    """The rows with their ``_block``, a block's rows together; ``block`` must not decrease with the order of the scan."""
    return df.withColumn("_block", block).repartition(*keys, "_block")


def block_window(keys: Sequence[str], order: str | Column, first: int, last: int) -> WindowSpec:
    """A window over the rows of one block, in order."""
    return Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(first, last)


def carry_over(
    rows: DataFrame, keys: Sequence[str], tail: Sequence[Column], carry: Callable[[DataFrame, WindowSpec], DataFrame]
) -> DataFrame:
    """One row a block with what ``carry`` makes of it: ``tail`` are aggregates of a block, and ``carry`` gets them with a window
    over all earlier blocks of the series."""
    blocks = rows.groupBy(*keys, "_block").agg(*tail)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return carry(blocks, earlier)


def with_carried(rows: DataFrame, carried: DataFrame, keys: Sequence[str], block: str = "_block") -> DataFrame:
    """The rows with the columns of their block; NULL is a key like any other."""
    names = {c: f"_carried_{i}" for i, c in enumerate([*keys, "_block"])}
    same = [F.col(block if c == "_block" else c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return rows.join(carried.withColumnsRenamed(names), same, "left").drop(*names.values())


def preceding_max(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, block: Column, name: str
) -> DataFrame:
    """Adds ``name``: the greatest ``value`` among rows of the key strictly before this one in ``order``.

    ``order`` must be unique per key and ``block`` must not decrease with it.
    """
    rows = in_blocks(df.withColumn("_value", value), keys, block)
    carried = carry_over(
        rows, keys, [F.max("_value").alias("_most")], lambda b, earlier: b.select(*keys, "_block", F.max("_most").over(earlier).alias("_carry"))
    )
    inside = F.max("_value").over(block_window(keys, order, Window.unboundedPreceding, -1))
    return (
        with_carried(rows.withColumn("_inside", inside), carried, keys)
        .withColumn(name, F.greatest("_inside", "_carry"))
        .drop("_block", "_value", "_inside", "_carry")
    )


def tick_gaps(df: DataFrame, dataset: str, ts: str = "ts", block: str = "1 hour") -> DataFrame:
    """Hours between successive distinct ticks of a dataset, one row per advance."""
    ticks = df.filter(F.col(ts).isNotNull()).select(dataset, ts).distinct()
    lagged = preceding_max(ticks, [dataset], ts, F.col(ts), time_block(ts, block), "previous_ts")
    hours = (F.unix_micros(ts) - F.unix_micros("previous_ts")) / F.lit(3.6e9)
    return lagged.filter(F.col("previous_ts").isNotNull()).select(
        dataset, ts, "previous_ts", hours.alias("gap_hours")
    )


def station_advances(
    snapshots: DataFrame,
    key: str = "fiwareid",
    ts: str = "ts",
    poll: str = "poll_seq",
    block: int = 4096,
    top: Column | None = None,
    remembered: DataFrame | None = None,
) -> DataFrame:
    """Per poll and station: the previously seen tick, whether it advanced, and what kind of poll it was.

    A poll is a DATASET ADVANCE when its greatest tick rises above all earlier ones (or it is the first);
    every station seen in it is then remembered at its tick, even an older one. Otherwise it is a PARTIAL
    ADVANCE if some station moved on, and only those are remembered; else NONE.

    ``top`` (the greatest tick of earlier polls) and ``remembered`` ``(key, ts)`` continue from polls that are not given.
    Across stations only one row per ``block`` polls is carried.
    """
    rows = snapshots.filter(F.col(ts).isNotNull()).groupBy(poll, key).agg(F.max(ts).alias(ts))
    polls = in_blocks(rows.groupBy(poll).agg(F.max(ts).alias("_tick")), [], number_block(poll, block))
    tops = carry_over(
        polls, [], [F.max("_tick").alias("_most")], lambda b, earlier: b.select("_block", F.max("_most").over(earlier).alias("_carry"))
    )
    inside = F.max("_tick").over(block_window([], poll, Window.unboundedPreceding, -1))
    known = F.lit(None).cast(rows.schema[ts].dataType) if top is None else top
    above = F.greatest("_inside", "_carry", known)
    resets = (above.isNull() | (F.col("_tick") > above)).alias("_resets")
    polls = with_carried(polls.withColumn("_inside", inside), tops, []).select(F.col(poll).alias("_poll"), resets)
    rows = in_blocks(rows.join(polls, F.col(poll) == F.col("_poll")).drop("_poll"), [key], number_block(poll, block))
    # A station's memory restarts at each dataset advance it appears in: that poll opens a segment. What it was last seen at
    # is the greatest tick of its latest segment before a poll.
    opened = F.max(F.when(F.col("_resets"), F.col(poll))).over(block_window([key], poll, Window.unboundedPreceding, 0))
    rows = rows.withColumn("_segment", opened)

    def carry(blocks: DataFrame, earlier) -> DataFrame:
        since = blocks.withColumn("_since", F.max("_tail._segment").over(earlier))
        whole = F.struct(F.coalesce("_tail._segment", "_since").alias("_segment"), F.col("_tail")[ts].alias(ts))
        return since.select(key, "_block", F.max(whole).over(earlier).alias("_carry"))

    carried = carry_over(rows, [key], [F.max(F.struct("_segment", ts)).alias("_tail")], carry)
    memory = F.max(F.struct("_segment", ts)).over(block_window([key], poll, Window.unboundedPreceding, -1))
    judged = with_carried(rows.withColumn("_memory", memory), carried, [key])
    # Without an advance of its block before it, a row goes on with the segment that was carried, or with what is remembered.
    last_seen = F.greatest(F.col("_memory")[ts], F.col("_carry")[ts])
    if remembered is not None:
        held = remembered.select(F.col(key).alias("_station"), F.col(ts).alias("_held"))
        judged = judged.join(held, F.col(key).eqNullSafe(F.col("_station")), "left")
        last_seen = F.when(F.col("_carry._segment").isNull(), F.greatest(last_seen, F.col("_held"))).otherwise(last_seen)
    last_seen = F.when(F.col("_memory._segment").isNotNull(), F.col("_memory")[ts]).otherwise(last_seen)
    judged = judged.select(poll, key, ts, "_resets", last_seen.alias("last_seen")).withColumn(
        "advanced", F.col("last_seen").isNull() | (F.col(ts) > F.col("last_seen"))
    )
    moved = judged.groupBy(F.col(poll).alias("_poll")).agg(F.bool_or("advanced").alias("_moved"), F.max(ts).alias("max_tick"))
    kind = (
        F.when(F.col("_resets"), "DATASET ADVANCE").when(F.col("_moved"), "PARTIAL ADVANCE").otherwise("NONE")
    )
    return judged.join(moved, F.col(poll) == F.col("_poll")).select(
        poll, key, ts, "max_tick", "last_seen", "advanced", kind.alias("poll_kind")
    )


def alert_sustained(
    df: DataFrame, condition: Column, hold, keys: Sequence[str], ts: str = "ts", block: str = "1 hour"
) -> DataFrame:
    """Unbroken runs of samples that meet the condition, and whether each lasted ``hold``.

    A run is named by the last failing sample before it, so runs come from one carried maximum and a
    combinable aggregate. Samples must be unique per key and instant.
    """
    met = F.coalesce(condition, F.lit(False))
    marked = preceding_max(
        df.select(*keys, ts, met.alias("_met")), list(keys), ts, F.when(~F.col("_met"), F.col(ts)), time_block(ts, block), "_broken"
    )
    length = (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1e6)
    return (
        marked.filter("_met")
        .groupBy(*keys, "_broken")
        .agg(
            F.min(ts).alias("since"),
            F.max(ts).alias("until"),
            F.count(F.lit(1)).alias("samples"),
            length.alias("held_seconds"),
        )
        .withColumn("firing", F.col("held_seconds") >= F.lit(interval_seconds(hold)))
        .drop("_broken")
    )
