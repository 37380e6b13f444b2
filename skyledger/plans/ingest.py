"""Polls and backfills as lazy plans."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skyledger.functions.numeric import parse_float_or_null
from skyledger.functions.time import combine_date_time, format_ts, interval_seconds
from skyledger.operators.changes import Changes, emit_changes
from skyledger.operators.joins import map_station_ids
from skyledger.operators.normalise import normalise, to_keyed_events
from skyledger.operators.filters import scan_range
from skyledger.operators.order import order_by_ts
from skyledger.operators.quality import load_report
from skyledger.sources.files import read_text, replace_text
from skyledger.sources.records import before_first_failure
from skyledger.spec import DatasetSpec


def poll(
    records: DataFrame,
    rejects: DataFrame | None,
    offset: DataFrame,
    seen: DataFrame,
    spec: DatasetSpec,
    scope: str = "dataset",
    requeued: DataFrame | None = None,
) -> tuple[DataFrame, Changes]:
    """One poll: records to canonical rows, change capture, and keyed JSON events.

    ``requeued`` rows (``key``, ``value``) failed before and are sent again as they are, beside the new events.
    """
    usable = records if rejects is None else before_first_failure(records, rejects)
    changes = emit_changes(normalise(usable, spec), offset, seen, spec, scope)
    keyed = to_keyed_events(changes.emitted, spec)
    return keyed if requeued is None else keyed.unionByName(requeued.select("key", "value")), changes


@dataclass(frozen=True)
class Backfill:
    """Rows ready for an upsert, the columns they set, and the load report."""

    rows: DataFrame
    columns: list[str]
    report: DataFrame


def backfill(history: DataFrame, names: DataFrame, spec: DatasetSpec) -> Backfill:
    """History rows of one dataset. Text columns the files lack are not set, so an upsert keeps them."""
    columns = [*spec.metrics, *spec.places]
    parsed = {out: parse_float_or_null(raw).alias(out) for raw, out in spec.history.items()}
    dim = names.select(F.col("historical_name").alias("estacion"), spec.key, "lat", "lon")
    # A left join serves both outcomes, so the file is read once per use instead of twice.
    judged = history.join(dim, "estacion", "left").select(
        spec.key, combine_date_time("fecha", "hora").alias(spec.ts), *[parsed[m] for m in spec.metrics], *spec.places
    )
    keep = F.col(spec.key).isNotNull() & F.col(spec.ts).isNotNull()
    if spec.required_history:
        keep = keep & F.col(spec.required_history).isNotNull()
    return Backfill(judged.filter(keep), columns, load_report(judged, keep))


def unmatched_names(history: DataFrame, names: DataFrame) -> DataFrame:
    """Historical names without a current station, with their row counts."""
    _, unmatched = map_station_ids(history, names)
    return unmatched.groupBy("estacion").agg(F.count(F.lit(1)).alias("rows"))


def replay(readings: DataFrame, spec: DatasetSpec, since=None, until=None, dry_run: bool = False) -> DataFrame:
    """Stored rows of ``[since, until)`` as keyed events in time order; a dry run gives only their number."""
    rows = scan_range(readings, spec.ts, since, until)
    if dry_run:
        return rows.agg(F.count(F.lit(1)).alias("events"))
    ordered = order_by_ts(rows, spec.ts, [spec.key])
    return to_keyed_events(ordered.withColumn(spec.ts, format_ts(spec.ts)), spec)


def send_events(keyed: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Keyed events to a topic, or appended to files of the same shape."""
    keyed.write.format(fmt).mode("append").options(**options).save()


def replay_slices(
    readings: DataFrame,
    spec: DatasetSpec,
    since: datetime,
    until: datetime,
    send: Callable[[DataFrame, int], None],
    checkpoint: str,
    width: str = "1 hour",
    per_second: float | None = None,
) -> int:
    """Replay ``[since, until)`` slice by slice in time order, at a bounded rate, from where an earlier call stopped.

    ``send`` gets the keyed events of a slice and its number. The checkpoint names the slices that were sent and is written
    after each, so a slice that was cut short is sent again under the same number and must replace what was sent of it. With
    ``per_second``, the next slice waits until the events so far would have taken that long; a slice itself is sent at
    once, so its width bounds the bursts. Returns the number of events sent by this call.
    """
    spark, step = readings.sparkSession, timedelta(seconds=interval_seconds(width))
    described = {"since": since.isoformat(), "until": until.isoformat(), "width": width}
    kept = json.loads(read_text(spark, checkpoint) or "null") or described | {"sent": 0}
    if {k: kept[k] for k in described} != described:
        raise ValueError(f"the checkpoint belongs to another replay: {kept}")
    began, total = time.monotonic(), 0
    for number in range(kept["sent"], -(-(until - since) // step)):
        low = since + number * step
        counted = Observation()
        keyed = replay(readings, spec, low, min(low + step, until)).observe(counted, F.count(F.lit(1)).alias("events"))
        send(keyed, number)
        replace_text(spark, checkpoint, json.dumps(described | {"sent": number + 1}))
        total += counted.get["events"]
        if per_second:
            time.sleep(max(0.0, total / per_second - (time.monotonic() - began)))
    return total
