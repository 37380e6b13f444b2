"""Streaming upsert, change capture, rollups, freshness and snapshot watching.

State and outputs that outlive a micro-batch are folders per run number. ``run_number`` numbers the batches of all queries that
ever wrote to a folder, in order: a batch that runs again keeps its number, and a new checkpoint, whose batches count from zero
again, goes on where the last one stopped. Run n reads the newest finished state below n and writes version n, so a batch that
runs again gives the same output.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.functions.numeric import circular_mean_deg
from skyledger.functions.time import BUCKET_ORIGIN, before, interval_seconds
from skyledger.operators.changes import changed_rows, next_state
from skyledger.operators.normalise import from_keyed_events, to_keyed_events
from skyledger.operators.quality import freshness, quarantine
from skyledger.operators.windows import last_row, station_advances
from skyledger.plans.rollup_jobs import refresh_touched
from skyledger.sources.files import create, exists, list_names, read_text, remove
from skyledger.sources.table import ReadingsTable
from skyledger.spec import DatasetSpec
from skyledger.session import literal_table

NOW = {"availableNow": True}


#: Changes that are kept beside a whole version before the next whole one is written.
CHANGES = 16


class VersionedState:
    """A table kept as whole versions and, where ``key`` is given, changed rows since, one folder per run."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str | None = None):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key

    def _finished(self, before: int) -> tuple[int | None, list[int]]:
        """The newest whole version below a run, and the runs of the changes after it."""
        found: dict[str, list[int]] = {"version": [], "change": []}
        for name in list_names(self.spark, self.path):
            kind, _, number = name.partition("=")
            if kind in found and int(number) < before and exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                found[kind].append(int(number))
        newest = max(found["version"], default=None)
        return newest, sorted(n for n in found["change"] if newest is None or n > newest)

    def before(self, run: int) -> DataFrame | None:
        newest, changes = self._finished(run)
        if newest is None:
            return None
        read = self.spark.read.schema(self.schema)
        whole = read.parquet(f"{self.path}/version={newest}")
        if not changes:
            return whole
        rows = whole.withColumn("_run", F.lit(newest))
        for n in changes:
            rows = rows.unionByName(read.parquet(f"{self.path}/change={n}").withColumn("_run", F.lit(n)))
        return last_row(rows, [self.key], ["_run"]).select(*whole.columns)

    def write(self, df: DataFrame, run: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/version={run}")

    def change(self, df: DataFrame, run: int) -> None:
        """Write the rows that take the place of those with their keys; every so often the whole table."""
        newest, changes = self._finished(run)
        if newest is None:
            self.write(df, run)
        elif len(changes) < CHANGES:
            df.write.mode("overwrite").parquet(f"{self.path}/change={run}")
        else:
            rows = self.before(run).withColumn("_new", F.lit(0)).unionByName(df.withColumn("_new", F.lit(1)))
            self.write(last_row(rows, [self.key], ["_new"]).select(*df.columns), run)

    def prune(self, run: int) -> None:
        """Call when all of a run is written: only a repeat of it reads what was before."""
        newest, _ = self._finished(run)
        if newest is not None:
            for kind in ("version", "change"):
                drop_before(self.spark, self.path, kind, newest)


def run_number(spark: SparkSession, path: str, checkpoint: str, batch_id: int) -> int:
    """The number of a batch among all batches of all queries over ``path``; one query runs at a time."""
    me = {"query": query_id(spark, checkpoint), "batch": batch_id}
    numbers = sorted(int(n) for n in list_names(spark, path) if n.isdigit())
    if numbers and json.loads(read_text(spark, f"{path}/{numbers[-1]}")) == me:
        return numbers[-1]
    number = numbers[-1] + 1 if numbers else 0
    if not create(spark, f"{path}/{number}", json.dumps(me)):
        raise RuntimeError(f"two queries write to {path} at once")
    for old in numbers[:-1]:
        remove(spark, f"{path}/{old}")
    return number


def drop_before(spark: SparkSession, path: str, name: str, first: int) -> None:
    for folder in list_names(spark, path):
        if folder.startswith(f"{name}=") and int(folder.split("=")[1]) < first:
            remove(spark, f"{path}/{folder}")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps across restarts; a new checkpoint has a new one."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger=None, mode="append"):
    return (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or NOW))
        .start()
    )


def stream_upsert(
    events: DataFrame, table: ReadingsTable, checkpoint: str, seq: str = "_seq", trigger=None, failed: str | None = None,
    rollups: dict[str, str] | None = None,
) -> StreamingQuery:
    """Keyed JSON events into the readings table; rows of any age are accepted.

    The last arrival of a key wins; equal arrival numbers fall back to the values, so a retry never differs. The
    query's own id names its batches in the table, so it shares the table with other writers and with a successor
    that starts from a new checkpoint. Events without station or instant go to the quarantine folder ``failed``
    before the rest is stored; without such a folder they stop the query. ``rollups`` maps bucket widths to stored rollups
    that are refreshed after each batch, in the chunks that it touched: there is no watermark, so rows of any age and
    corrections count in their buckets as if they had come in time.
    """
    spec = table.spec

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = from_keyed_events(batch.withColumns({"_key": F.col("key"), "_value": F.col("value")}), spec)
        broken = F.col(spec.key).isNull() | F.col(spec.ts).isNull()
        writer = query_id(batch.sparkSession, checkpoint)
        if failed is None:
            complaint = F.raise_error(F.concat(F.lit("event without station or instant: "), F.coalesce("_value", F.lit("null"))))
            rows = parsed.filter(F.when(~broken, True).otherwise(complaint.cast("boolean")))
            table.upsert(rows, batch_id, seq=[seq, *spec.values], writer=writer)
        else:
            # Parsed once for both writes; only broken events keep their text.
            parsed = parsed.withColumns({c: F.when(broken, F.col(c)) for c in ("_key", "_value")}).persist()
            try:
                apart = parsed.filter(broken).select(F.col("_key").alias("key"), F.col("_value").alias("value"))
                quarantine(apart, failed, batch_id, writer=writer)
                table.upsert(parsed.filter(~broken), batch_id, seq=[seq, *spec.values], writer=writer)
            finally:
                parsed.unpersist()
        for width, path in (rollups or {}).items():
            refresh_touched(table, path, width)

    return start(events, handle, checkpoint, trigger)


def stream_emit_changes(
    canonical: DataFrame,
    state_path: str,
    out_path: str,
    spec: DatasetSpec,
    checkpoint: str,
    start_offset: str = "1970-01-01T00:00:00Z",
    scope: str = "dataset",
    seq: str = "_seq",
    trigger=None,
) -> StreamingQuery:
    """Change capture over a stream of canonical rows with fingerprints; emits keyed events per batch.

    Emitted rows are stored once; events and the next state are made from the stored rows, the state last,
    so a failure anywhere repeats the batch with the old state.
    """
    spark = canonical.sparkSession
    offsets = VersionedState(spark, f"{state_path}/offset", "offset string")
    seen_schema = f"{spec.key} string, _fp string" if scope == "dataset" else f"{spec.key} string, offset string, _fp string"
    seens = VersionedState(spark, f"{state_path}/seen", seen_schema, spec.key)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = run_number(session, f"{state_path}/runs", checkpoint, batch_id)
        offset, seen = offsets.before(run), seens.before(run)
        if offset is None or seen is None:
            offset = literal_table(session, [(start_offset,)], "offset string")
            seen = literal_table(session, [], seen_schema)
        kept = f"{state_path}/emitted/batch_id={run}"
        changed_rows(batch, offset, seen, spec, scope).write.mode("overwrite").parquet(kept)
        emitted = session.read.schema(batch.schema).parquet(kept)
        to_keyed_events(emitted, spec).write.mode("overwrite").parquet(f"{out_path}/batch_id={run}")
        next_offset, next_seen = next_state(emitted, offset, seen, spec, scope, seq)
        if scope == "station":
            # Only stations that emitted something have news; an offset never falls, so the greatest is among them or the old one.
            moved = emitted.select(F.col(spec.key).alias("_station")).distinct()
            seens.change(next_seen.join(moved, F.col(spec.key) == F.col("_station"), "left_semi"), run)
        else:
            seens.write(next_seen, run)
        offsets.write(next_offset, run)
        seens.prune(run)
        offsets.prune(run)
        drop_before(session, f"{state_path}/emitted", "batch_id", run)

    return start(canonical, handle, checkpoint, trigger)


def stream_rollup(readings: DataFrame, spec: DatasetSpec, width: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """The rollups over a stream; the watermark bounds state and leaves out rows that come after it. ``stream_upsert`` with
    ``rollups`` counts those as well."""
    # Windows count from the epoch, buckets from their own origin.
    origin = datetime.fromisoformat(BUCKET_ORIGIN).replace(tzinfo=timezone.utc).timestamp()
    shift = f"{int(origin) % interval_seconds(width)} seconds"
    kinds = {"avg": F.avg, "max": F.max, "circular": circular_mean_deg}
    return (
        readings.withWatermark(spec.ts, watermark)
        .groupBy(F.col(spec.key), F.window(spec.ts, width, width, shift).alias("bucket"))
        .agg(*[kinds[kind](source).alias(out) for out, kind, source in spec.rollup])
        .select(spec.key, F.col("bucket.start").alias("bucket_start"), *[out for out, _, _ in spec.rollup])
    )


def write_rollup_stream(rolled: DataFrame, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """Changed buckets of every micro-batch, one folder per run, whichever checkpoint it belongs to."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = run_number(batch.sparkSession, f"{path}/_runs", checkpoint, batch_id)
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={run}")

    return start(rolled, handle, checkpoint, trigger, mode="update")


def read_rollup_stream(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """The newest version of every bucket."""
    versions = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))
    return last_row(versions, [spec.key, "bucket_start"], ["batch_id"]).drop("batch_id")


def stream_freshness(
    events: DataFrame,
    expected: DataFrame,
    state_path: str,
    out_path: str,
    checkpoint: str,
    window="30 minutes",
    hold="30 minutes",
    dataset: str = "dataset",
    ts: str = "ts",
    clock=None,
    trigger=None,
) -> StreamingQuery:
    """Freshness judged after every micro-batch against the clock, as over all rows so far.

    A source that ticks every second is joined in as rows without a dataset, so there are batches, and reports, when all
    feeds are silent. Remembers how many rows each dataset has per instant, back to where the report still looks; rows ahead
    of the clock wait there for their time.
    """
    spark = events.sparkSession
    state = VersionedState(spark, state_path, f"{dataset} string, {ts} timestamp, _n long")
    reach = interval_seconds(window) + interval_seconds(hold)
    rows = events.select(F.col(dataset).cast("string").alias(dataset), F.col(ts).cast("timestamp").alias(ts))
    ticks = spark.readStream.format("rate").load().select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = run_number(batch.sparkSession, f"{state_path}/runs", checkpoint, batch_id)
        rows = batch.filter(F.col(ts).isNotNull()).groupBy(dataset, ts).agg(F.count(F.lit(1)).alias("_n"))
        known = state.before(run)
        if known is not None:
            rows = rows.unionByName(known).groupBy(dataset, ts).agg(F.sum("_n").alias("_n"))
        state.write(rows.filter(F.col(ts) > before(clock, reach)), run)
        kept = spark.read.schema(state.schema).parquet(f"{state_path}/version={run}")
        report = freshness(kept, expected, clock, window, hold, dataset, ts, weight="_n")
        report.write.mode("overwrite").parquet(f"{out_path}/batch_id={run}")
        state.prune(run)

    return start(rows.unionByName(ticks), handle, checkpoint, trigger)


def snapshot_diff_stream(
    snapshots: DataFrame,
    state_path: str,
    out_path: str,
    checkpoint: str,
    key: str = "fiwareid",
    ts: str = "ts",
    poll: str = "poll_seq",
    trigger=None,
) -> StreamingQuery:
    """Station and dataset advances over a stream of polls, whole polls per micro-batch and in order.

    Remembered are the greatest tick, the last poll, and the tick of every station, of which a batch writes only those that
    it saw. Any id is a station's, the empty one and NULL as well. A poll that comes again, or after a later one, stops the
    query; polls that an earlier query has judged are passed over, so a new checkpoint may start from the beginning.
    """
    spark = snapshots.sparkSession
    top = VersionedState(spark, f"{state_path}/top", f"{ts} timestamp, {poll} long, _query string")
    seen = VersionedState(spark, f"{state_path}/seen", f"{key} string, {ts} timestamp", key)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run, me = run_number(session, f"{state_path}/runs", checkpoint, batch_id), query_id(session, checkpoint)
        rows = batch.select(F.col(poll).cast("long").alias(poll), F.col(key).cast("string").alias(key), ts)
        known, peak = seen.before(run), top.before(run)
        held = peak.first() if peak is not None else None
        if held is not None:
            again = F.col(poll) <= F.lit(held[poll])
            if held["_query"] == me:
                stop = F.raise_error(F.concat(F.lit("poll out of order: "), F.col(poll).cast("string")))
                rows = rows.filter(F.when(again, stop.cast("boolean")).otherwise(True))
            else:
                rows = rows.filter(~again)
        judged_path = f"{out_path}/batch_id={run}"
        first = None if held is None or held[ts] is None else F.lit(held[ts])
        station_advances(rows, key, ts, poll, top=first, remembered=known).write.mode("overwrite").parquet(judged_path)
        judged = session.read.parquet(judged_path)
        # A station is remembered at the greatest tick since its last dataset advance of this batch, if there was one.
        since = F.max(F.when(F.col("poll_kind") == "DATASET ADVANCE", F.col(poll)))
        restarted = judged.groupBy(F.col(key).alias("_station")).agg(since.alias("_from"))
        kept = judged.join(restarted, F.col(key).eqNullSafe(F.col("_station")))
        tick = F.when(F.col("_from").isNull(), F.greatest(ts, "last_seen")).when(F.col(poll) >= F.col("_from"), F.col(ts))
        seen.change(kept.groupBy(key).agg(F.max(tick).alias(ts)), run)
        ends = judged.agg(F.max("max_tick").alias(ts), F.max(poll).alias(poll))
        old_tick, old_poll = (None, None) if held is None else (held[ts], held[poll])
        greater = lambda c, old, kind: F.greatest(c, F.lit(old).cast(kind)).alias(c)
        top.write(ends.select(greater(ts, old_tick, "timestamp"), greater(poll, old_poll, "long"), F.lit(me).alias("_query")), run)
        seen.prune(run)
        top.prune(run)

    return start(snapshots, handle, checkpoint, trigger)
