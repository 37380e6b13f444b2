"""The upserted table, stored rollups, and streaming jobs, run over the whole events table."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from skyledger.functions.fingerprint import value_fingerprint
from skyledger.functions.time import format_ts
from skyledger.operators.quality import mark_consumed, requeue
from skyledger.plans.newest import latest_stored, newest_rows
from skyledger.plans.rollup_jobs import RollupStore, policy_checks, read_rollup, refresh_from, refresh_rollup, refresh_touched, stored_checks
from skyledger.registry.core import NOW_SQL, R, as_readings, event_stream, events, landed_parts, query, readings, rounded
from skyledger.registry.ingest import HOURLY
from skyledger.registry.lookups import ADVANCES_SQL, polls
from skyledger.registry.series import AIR_ROLLUP_SQL, WEATHER_ROLLUP_SQL, rollup_sql
from skyledger.session import literal_table, work_dir
from skyledger.sources.records import read_event_stream
from skyledger.sources.table import ReadingsTable
from skyledger.spec import AIR, WEATHER
from skyledger.streaming import jobs as X

# A moment shortly after the data ends, standing in for now where a job needs a plain datetime.
AFTER = datetime(2024, 2, 1)

# Three statements over the whole table: two set every column, the last one is a backfill that leaves the
# summary alone. Instants are cut to the day, so stations collide with themselves within and across batches.
BATCHES = [(0, ["click", "view"], None), (1, ["purchase", "signup"], None), (2, ["error"], [*AIR.metrics, "lat", "lon"])]

UPSERT_SQL = f"""{R}, b AS (SELECT *, date_trunc('day', ts) AS day,
    CASE WHEN event_type IN ('click', 'view') THEN 0 WHEN event_type = 'error' THEN 2 ELSE 1 END AS batch FROM r),
  w AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY fiwareid, day, batch ORDER BY event_id DESC) = 1),
  t AS (SELECT fiwareid, day AS ts, {", ".join(f"last({c} ORDER BY batch) AS {c}" for c in [*AIR.metrics, "lat", "lon"])},
    last(air_quality_summary ORDER BY batch) FILTER (WHERE batch < 2) AS air_quality_summary FROM w GROUP BY 1, 2)"""
UPSERT_COLS = "fiwareid, ts, no2, o3, so2, co, pm10, pm25, air_quality_summary, lat, lon"


def daily_rows(rows):
    return rows.withColumn("ts", F.date_trunc("day", "ts"))


def filled_table(spark, sf, batches=BATCHES) -> ReadingsTable:
    table = ReadingsTable(spark, work_dir(spark, "table"), AIR)
    rows = daily_rows(readings(spark, sf))
    for batch_id, types, cols in batches:
        table.upsert(rows.filter(F.col("event_type").isin(types)), batch_id, cols, seq="event_id")
    return table


@query("upsert_table", f"WITH {UPSERT_SQL} SELECT {UPSERT_COLS} FROM t")
def _(spark, sf):
    return filled_table(spark, sf).read().select(*[c.strip() for c in UPSERT_COLS.split(",")])


@query("upsert_table_compacted", f"WITH {UPSERT_SQL} SELECT {UPSERT_COLS} FROM t")
def _(spark, sf):
    table = filled_table(spark, sf, BATCHES[:2])
    table.compact(before=datetime(2024, 1, 22).date())
    rows = daily_rows(readings(spark, sf))
    table.upsert(rows.filter(F.col("event_type") == "error"), 2, BATCHES[2][2], seq="event_id")
    # Running the last statement once more must not change anything.
    table.upsert(rows.filter(F.col("event_type") == "error"), 2, BATCHES[2][2], seq="event_id")
    table.compact()
    table.vacuum()
    return table.read().select(*[c.strip() for c in UPSERT_COLS.split(",")])


@query(
    "upsert_table_range",
    f"WITH {UPSERT_SQL} SELECT fiwareid, ts, pm25 FROM t WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'",
)
def _(spark, sf):
    table = filled_table(spark, sf)
    return table.read(datetime(2024, 1, 10), datetime(2024, 1, 17)).select("fiwareid", "ts", "pm25")


@query(
    "retention",
    f"""WITH {UPSERT_SQL} SELECT fiwareid, ts FROM t
    WHERE time_bucket(INTERVAL '7 days', ts) + INTERVAL '7 days' > TIMESTAMP '2024-01-18'""",
)
def _(spark, sf):
    table = filled_table(spark, sf)
    table.retention(AFTER, 14)
    return table.read().select("fiwareid", "ts")


@query(
    "stored_rollup_daily",
    rollup_sql(WEATHER_ROLLUP_SQL, "1 day", "bucket_day").replace(
        "FROM r GROUP", "FROM r WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-30' GROUP"
    ),
)
def _(spark, sf):
    folder = work_dir(spark, "rollup")
    rows = readings(spark, sf)
    # An earlier refresh saw only some rows; the next one replaces its buckets and adds the newer ones.
    refresh_rollup(rows.filter("event_type <> 'view'"), folder, WEATHER, "1 day", "20 days", "1 day", datetime(2024, 1, 25, 6))
    refresh_rollup(rows, folder, WEATHER, "1 day", "26 days", "1 day", datetime(2024, 1, 31, 6))
    stored = read_rollup(spark, folder, WEATHER, "1 day")
    return rounded(stored.filter(F.col("bucket_day") >= F.lit("2024-01-11").cast("timestamp")))


@query(
    "stored_rollup_realtime",
    rollup_sql(AIR_ROLLUP_SQL, "7 days", "bucket_week"),
)
def _(spark, sf):
    folder = work_dir(spark, "rollup")
    rows = readings(spark, sf)
    refresh_rollup(rows, folder, AIR, "7 days", "180 days", "1 day", datetime(2024, 1, 25))
    return rounded(read_rollup(spark, folder, AIR, "7 days", rows, realtime=True))


@query(
    "table_checks",
    f"""WITH {UPSERT_SQL}, d AS (SELECT DISTINCT fiwareid, time_bucket(INTERVAL '1 day', ts) AS bucket FROM r
      WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-30')
    SELECT 'readings' AS table_name, count(*) AS rows, 'absent_column' AS missing,
      count(*) FILTER (WHERE ts < TIMESTAMP '2024-02-01' - INTERVAL '20 days') AS overdue FROM t
    UNION ALL SELECT 'rollup', count(*), '', 0 FROM d""",
)
def _(spark, sf):
    folder = work_dir(spark, "checks")
    refresh_rollup(readings(spark, sf), folder, AIR, "1 day", "26 days", "1 day", datetime(2024, 1, 31, 6))
    stored = {"readings": filled_table(spark, sf).read(), "rollup": read_rollup(spark, folder, AIR, "1 day")}
    expected = {"readings": ["fiwareid", "ts", "no2", "absent_column"], "rollup": ["fiwareid", "bucket_day", "no2_avg"]}
    return stored_checks(stored, expected, {"readings": "ts"}, {"readings": 20}, AFTER)


@query(
    "stored_rollup_range",
    rollup_sql(WEATHER_ROLLUP_SQL, "1 day", "bucket_day").replace(
        "FROM r GROUP", "FROM r WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-15' GROUP"
    ),
)
def _(spark, sf):
    folder = work_dir(spark, "rollup")
    refresh_rollup(readings(spark, sf), folder, WEATHER, "1 day", "26 days", "1 day", datetime(2024, 1, 31, 6))
    return rounded(read_rollup(spark, folder, WEATHER, "1 day", since=datetime(2024, 1, 11), until=datetime(2024, 1, 15)))


GONE = ["S7", "S8"]
MOVED = [("S3", "S4"), ("S5", "S4"), ("S6", "S9"), ("S9", "S6")]
MOVED_SQL = "CASE fiwareid " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in MOVED) + " ELSE fiwareid END"


@query(
    "table_renamed_and_deleted",
    f"""WITH {UPSERT_SQL}, kept AS (SELECT * FROM t WHERE fiwareid NOT IN ({", ".join(f"'{x}'" for x in GONE)})),
    m AS (SELECT {MOVED_SQL} AS station, fiwareid <> {MOVED_SQL} AS moved, fiwareid AS was, ts, no2, pm25, air_quality_summary FROM kept),
    s AS (SELECT DISTINCT ON (station, ts) station AS fiwareid, ts, no2, pm25, air_quality_summary FROM m
          ORDER BY station, ts, moved DESC, was DESC),
    late AS (SELECT DISTINCT ON (fiwareid, day) fiwareid, day AS ts, no2, pm25, air_quality_summary
             FROM (SELECT *, date_trunc('day', ts) AS day FROM r WHERE fiwareid IN ('S3', 'S4', 'S7') AND event_type = 'view')
             ORDER BY fiwareid, day, event_id DESC)
    SELECT * FROM late UNION ALL SELECT * FROM s ANTI JOIN late USING (fiwareid, ts)""",
)
def _(spark, sf):
    table = filled_table(spark, sf)
    station = lambda names: literal_table(spark, [(n,) for n in names], "fiwareid string")
    table.delete(station(GONE), 0, writer="consolidation")
    table.compact(before=datetime(2024, 1, 15).date())
    mapping = literal_table(spark, MOVED, "old_id string, new_id string")
    for _ in range(2):  # the second time changes nothing
        table.rename(mapping, 1, writer="consolidation")
    # A backfill afterwards: retired and deleted ids may come back.
    late = daily_rows(readings(spark, sf)).filter(F.col("fiwareid").isin("S3", "S4", "S7") & (F.col("event_type") == "view"))
    table.upsert(late, 3, seq="event_id")
    opened = table.read()
    # A read that is open survives the folding and clearing away of what it reads.
    table.compact()
    table.vacuum()
    return opened.select("fiwareid", "ts", "no2", "pm25", "air_quality_summary")


@query("latest_stored", f"WITH {UPSERT_SQL} SELECT DISTINCT ON (fiwareid) fiwareid, ts, pm25, air_quality_summary FROM t ORDER BY fiwareid, ts DESC")
def _(spark, sf):
    table = filled_table(spark, sf)
    stations = readings(spark, sf).select("fiwareid").distinct()
    return latest_stored(table, stations, ["pm25", "air_quality_summary"])


@query("newest_stored_rows", f"WITH {UPSERT_SQL} SELECT fiwareid, ts, pm25 FROM t ORDER BY ts DESC, fiwareid LIMIT 500")
def _(spark, sf):
    return newest_rows(filled_table(spark, sf), 500).select("fiwareid", "ts", "pm25")


@query(
    "policy_checks",
    f"""WITH {UPSERT_SQL} SELECT 'readings' AS table_name, * FROM (VALUES ('chunk_days', 7::BIGINT, 7::BIGINT, true),
      ('compress_after_days', 30, NULL, NULL), ('retention_days', 14, 14, true)) p(policy, expected, kept, as_expected)
    UNION ALL SELECT 'rows after retention', 'retention_days', NULL, (SELECT count(*) FROM t
      WHERE time_bucket(INTERVAL '7 days', ts) + INTERVAL '7 days' > TIMESTAMP '2024-01-18'), NULL""",
)
def _(spark, sf):
    table = filled_table(spark, sf)
    table.set_policies(retention_days=14)
    table.retention(AFTER)
    checks = policy_checks({"readings": table}, {"readings": {"chunk_days": 7, "retention_days": 14, "compress_after_days": 30}})
    left = table.read().agg(F.count(F.lit(1)).alias("kept")).select(
        F.lit("rows after retention").alias("table_name"), F.lit("retention_days").alias("policy"), F.lit(None).cast("long").alias("expected"),
        "kept", F.lit(None).cast("boolean").alias("as_expected"),
    )
    return checks.withColumn("as_expected", F.when(F.col("kept").isNotNull(), F.col("as_expected"))).unionByName(left)


def rollup_of(sql: str, width: str, bucket: str) -> str:
    """The rollup of a table ``t`` that ``sql`` defines."""
    return f"WITH {sql} SELECT fiwareid, time_bucket(INTERVAL '{width}', ts) AS {bucket}, {AIR_ROLLUP_SQL} FROM t GROUP BY ALL"


@query("stored_rollup_touched", rollup_of(UPSERT_SQL, "1 day", "bucket_day"))
def _(spark, sf):
    folder, table = work_dir(spark, "rollup"), filled_table(spark, sf, BATCHES[:2])
    refresh_touched(table, folder)
    # A backfill comes late: only the buckets of its chunks are made again.
    table.upsert(daily_rows(readings(spark, sf)).filter(F.col("event_type") == "error"), 2, BATCHES[2][2], seq="event_id")
    refresh_touched(table, folder)
    return rounded(read_rollup(spark, folder, AIR))


@query("stored_rollup_weekly_from_daily", rollup_of(UPSERT_SQL, "7 days", "bucket_week"))
def _(spark, sf):
    folder, table = work_dir(spark, "rollup"), filled_table(spark, sf, BATCHES[:2])
    daily, weekly = RollupStore(spark, f"{folder}/daily", AIR), RollupStore(spark, f"{folder}/weekly", AIR, "7 days")
    refresh_touched(table, daily.path)
    refresh_from(daily, weekly)
    table.upsert(daily_rows(readings(spark, sf)).filter(F.col("event_type") == "error"), 2, BATCHES[2][2], seq="event_id")
    refresh_touched(table, daily.path)
    refresh_from(daily, weekly)
    return rounded(read_rollup(spark, weekly.path, AIR, "7 days"))


# -- streams: events arrive in parts of whole days, and each part is a micro-batch of its own


def keyed(rows):
    """Hourly events as they come over the wire; some texts are cut off, some instants can't be read."""
    hourly = as_readings(rows).withColumn("ts", F.date_trunc("hour", "ts"))
    at = F.when(F.col("event_id") % 50 == 9, F.lit("soon")).otherwise(format_ts("ts"))
    value = F.to_json(F.struct("fiwareid", at.alias("ts"), *AIR.values), {"ignoreNullFields": "false"})
    return hourly.select(
        F.concat_ws("|", "fiwareid", format_ts("ts")).alias("key"),
        F.when(F.col("event_id") % 50 == 7, F.substring(value, 1, 20)).otherwise(value).alias("value"),
        F.col("event_id").alias("seq"),
    )


def streamed_table(spark, sf, folder):
    table = ReadingsTable(spark, f"{folder}/table", AIR)
    for _ in landed_parts(spark, sf, f"{folder}/in", shape=keyed):
        stream = read_event_stream(spark, "json", {"path": f"{folder}/in"})
        X.stream_upsert(stream, table, f"{folder}/checkpoint", failed=f"{folder}/failed").awaitTermination()
    return table


GOOD = "event_id % 50 NOT IN (7, 9)"
HOURLY_SQL = f"""{R}, g AS (SELECT *, date_trunc('hour', ts) AS hour FROM r WHERE {GOOD}),
  t AS (SELECT DISTINCT ON (fiwareid, hour) fiwareid, hour AS ts, no2, pm25, air_quality_summary FROM g
        ORDER BY fiwareid, hour, event_id DESC)"""


@query("stream_upsert", f"WITH {HOURLY_SQL} SELECT * FROM t")
def _(spark, sf):
    table = streamed_table(spark, sf, work_dir(spark, "stream"))
    return table.read().select("fiwareid", "ts", "no2", "pm25", "air_quality_summary")


@query(
    "stream_upsert_quarantine",
    f"""WITH {R} SELECT fiwareid || '|' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS key,
      event_id % 50 = 7 AS cut_off FROM r WHERE NOT ({GOOD})""",
)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    streamed_table(spark, sf, folder)
    waiting, _ = requeue(spark, f"{folder}/failed")
    return waiting.select("key", (F.length("value") == 20).alias("cut_off"))


@query(
    "table_of_two_writers",
    f"""WITH {HOURLY_SQL},
    b AS (SELECT DISTINCT ON (fiwareid, hour) fiwareid, hour AS ts, -1e0 AS no2, air_quality_summary FROM
            (SELECT *, date_trunc('hour', ts) AS hour FROM r WHERE event_id % 3 = 0) ORDER BY fiwareid, hour, event_id DESC),
    late AS (SELECT DISTINCT fiwareid, date_trunc('hour', ts) AS ts FROM r WHERE event_id % 10 = 1)
    SELECT coalesce(late.fiwareid, t.fiwareid, b.fiwareid) AS fiwareid, coalesce(late.ts, t.ts, b.ts) AS ts,
      CASE WHEN late.ts IS NOT NULL THEN -2e0 WHEN t.ts IS NOT NULL THEN t.no2 ELSE b.no2 END AS no2,
      CASE WHEN t.ts IS NOT NULL THEN t.air_quality_summary ELSE b.air_quality_summary END AS air_quality_summary
    FROM b FULL JOIN t USING (fiwareid, ts) FULL JOIN late USING (fiwareid, ts)""",
)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    rows = readings(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    table = ReadingsTable(spark, f"{folder}/table", AIR)
    table.upsert(rows.filter("event_id % 3 = 0").withColumn("no2", F.lit(-1.0)), 0, seq="event_id", writer="backfill")
    streamed_table(spark, sf, folder)
    # The stream starts over from a new checkpoint, a compaction runs, and an older batch number comes late.
    again = read_event_stream(spark, "json", {"path": f"{folder}/in"})
    X.stream_upsert(again, table, f"{folder}/checkpoint-2", failed=f"{folder}/failed-2").awaitTermination()
    table.upsert(rows.filter("false"), 7, writer="backfill")
    table.compact()
    late = rows.filter("event_id % 10 = 1").withColumn("no2", F.lit(-2.0))
    table.upsert(late, 3, ["no2"], seq="event_id", writer="backfill")
    table.vacuum()
    return table.read().select("fiwareid", "ts", "no2", "air_quality_summary")


@query(
    "upsert_without_sequence",
    f"""WITH {R} SELECT DISTINCT ON (fiwareid, day) fiwareid, day AS ts, no2, o3, so2, co, pm10, pm25, air_quality_summary
    FROM (SELECT *, date_trunc('day', ts) AS day FROM r)
    ORDER BY fiwareid, day, {", ".join(f"{c} DESC NULLS LAST" for c in AIR.values)}""",
)
def _(spark, sf):
    table = ReadingsTable(spark, work_dir(spark, "table"), AIR)
    table.upsert(daily_rows(readings(spark, sf)), 0)
    return table.read().select("fiwareid", "ts", "no2", "o3", "so2", "co", "pm10", "pm25", "air_quality_summary")


@query(
    "stream_emit_changes",
    f"""WITH {HOURLY} SELECT fiwareid || '|' || ts AS key FROM h WHERE ts >= '2024-01-10T00:00:00Z'""",
)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    for _ in landed_parts(spark, sf, f"{folder}/in"):
        rows = as_readings(event_stream(spark, f"{folder}/in")).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'Z'"))
        canonical = rows.select(*AIR.columns, F.col("event_id").alias("_seq")).withColumn(
            "_fp", value_fingerprint(AIR.change_cols)
        )
        X.stream_emit_changes(
            canonical, f"{folder}/state", f"{folder}/out", AIR, f"{folder}/checkpoint", "2024-01-10T00:00:00Z"
        ).awaitTermination()
    return spark.read.schema("key string, value string").parquet(f"{folder}/out").select("key")


@query(
    "stream_rollup",
    rollup_sql(WEATHER_ROLLUP_SQL, "7 days", "bucket_start"),
)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    for _ in landed_parts(spark, sf, f"{folder}/in"):
        rolled = X.stream_rollup(as_readings(event_stream(spark, f"{folder}/in")), WEATHER, "7 days", "40 days")
        X.write_rollup_stream(rolled, f"{folder}/rollup", f"{folder}/checkpoint").awaitTermination()
    return rounded(X.read_rollup_stream(spark, f"{folder}/rollup", WEATHER))


CLOCK = "TIMESTAMP '2024-01-28 12:00:00'"


@query(
    "stream_freshness",
    f"""SELECT event_type AS dataset,
      count(*) FILTER (WHERE ts > {CLOCK} - INTERVAL '30 minutes' AND ts <= {CLOCK}) AS rows_in_window,
      CASE WHEN max(ts) FILTER (WHERE ts <= {CLOCK}) > {CLOCK} - INTERVAL '30 minutes' THEN 'ok'
           WHEN max(ts) FILTER (WHERE ts <= {CLOCK}) > {CLOCK} - INTERVAL '60 minutes' THEN 'pending' ELSE 'firing' END AS state
    FROM events GROUP BY event_type""",
)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    expected = events(spark, sf).select(F.col("event_type").alias("dataset")).distinct()
    # Readings up to two days ahead of the clock must not hide those in the window.
    for _ in landed_parts(spark, sf, f"{folder}/in"):
        stream = event_stream(spark, f"{folder}/in").select(F.col("event_type").alias("dataset"), "ts")
        X.stream_freshness(
            stream, expected, f"{folder}/state", f"{folder}/out", f"{folder}/checkpoint", clock="2024-01-28T12:00:00"
        ).awaitTermination()
    report = spark.read.parquet(f"{folder}/out")
    newest = report.agg(F.max("batch_id")).scalar()
    return report.filter(F.col("batch_id") == newest).select("dataset", "rows_in_window", "state")


@query("stream_snapshot_diff", ADVANCES_SQL)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    for _ in landed_parts(spark, sf, f"{folder}/in"):
        snapshots = polls(event_stream(spark, f"{folder}/in"))
        X.snapshot_diff_stream(snapshots, f"{folder}/state", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


@query("stream_rollup_late", rollup_of(
    f"""{R}, g AS (SELECT *, date_trunc('hour', ts) AS hour FROM r WHERE {GOOD}),
    t AS (SELECT DISTINCT ON (fiwareid, hour) fiwareid, hour AS ts, {", ".join(AIR.values)} FROM g
          ORDER BY fiwareid, hour, event_id % 3 DESC, event_id DESC)""", "1 day", "bucket_day"
))
def _(spark, sf):
    folder = work_dir(spark, "stream")
    table = ReadingsTable(spark, f"{folder}/table", AIR)
    # Each part holds rows of all days, so most rows of the later ones come long after newer rows.
    for part in range(3):
        keyed(events(spark, sf).filter(F.col("event_id") % 3 == part)).write.mode("append").json(f"{folder}/in")
        stream = read_event_stream(spark, "json", {"path": f"{folder}/in"})
        rollups = {"1 day": f"{folder}/daily"}
        X.stream_upsert(stream, table, f"{folder}/checkpoint", failed=f"{folder}/failed", rollups=rollups).awaitTermination()
    return rounded(read_rollup(spark, f"{folder}/daily", AIR))


# -- streams that start over: a successor with a checkpoint of its own goes on in the same folders


def checkpoints(folder, n, parts=5):
    """The first checkpoint for the earlier parts, a second one for the rest."""
    return f"{folder}/checkpoint-{int(n >= parts // 2)}"


@query(
    "stream_quarantine_restarted",
    f"""WITH {R} SELECT fiwareid || '|' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS key, event_id % 50 = 7 AS cut_off
    FROM r WHERE NOT ({GOOD})""",
)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    table = ReadingsTable(spark, f"{folder}/table", AIR)
    # The successor reads a folder of its own; its batches count from zero like those before it.
    for n, (low, high) in enumerate((("2000-01-01", "2024-01-15"), ("2024-01-15", "2100-01-01"))):
        landed = events(spark, sf).filter((F.col("ts") >= low) & (F.col("ts") < high))
        keyed(landed).write.json(f"{folder}/in-{n}")
        stream = read_event_stream(spark, "json", {"path": f"{folder}/in-{n}"})
        X.stream_upsert(stream, table, f"{folder}/checkpoint-{n}", failed=f"{folder}/failed").awaitTermination()
        waiting, batches = requeue(spark, f"{folder}/failed")
        waiting.write.parquet(f"{folder}/handed/turn={n}")
        mark_consumed(spark, f"{folder}/failed", batches)
    return spark.read.parquet(f"{folder}/handed").select("key", (F.length("value") == 20).alias("cut_off"))


@query("stream_rollup_restarted", rollup_sql(AIR_ROLLUP_SQL, "7 days", "bucket_start"))
def _(spark, sf):
    folder = work_dir(spark, "stream")
    for n in landed_parts(spark, sf, f"{folder}/in", parts=4):
        rolled = X.stream_rollup(as_readings(event_stream(spark, f"{folder}/in")), AIR, "7 days", "40 days")
        X.write_rollup_stream(rolled, f"{folder}/rollup", checkpoints(folder, n, 4)).awaitTermination()
    return rounded(X.read_rollup_stream(spark, f"{folder}/rollup", AIR))


@query("stream_snapshot_diff_restarted", ADVANCES_SQL)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    for n in landed_parts(spark, sf, f"{folder}/in", parts=4):
        snapshots = polls(event_stream(spark, f"{folder}/in"))
        X.snapshot_diff_stream(snapshots, f"{folder}/state", f"{folder}/out", checkpoints(folder, n, 4)).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


@query(
    "stream_freshness_silence",
    f"""SELECT event_type AS dataset, late AS minutes_later,
      count(*) FILTER (WHERE ts > {NOW_SQL} + to_minutes(late) - INTERVAL '6 hours') AS rows_in_window,
      CASE WHEN max(ts) > {NOW_SQL} + to_minutes(late) - INTERVAL '6 hours' THEN 'ok'
           WHEN max(ts) > {NOW_SQL} + to_minutes(late) - INTERVAL '12 hours' THEN 'pending' ELSE 'firing' END AS state
    FROM events, (SELECT unnest([0, 420, 2000]) AS late) GROUP BY event_type, late""",
)
def _(spark, sf):
    folder = work_dir(spark, "stream")
    rows = events(spark, sf)
    rows.write.parquet(f"{folder}/in")
    expected = rows.select(F.col("event_type").alias("dataset")).distinct()
    newest = rows.agg(F.max("ts").alias("now")).first()["now"]
    out = None
    # All events come before the first report; then the feeds stop, and the clock alone makes batches.
    for late in (0, 420, 2000):
        stream = event_stream(spark, f"{folder}/in").select(F.col("event_type").alias("dataset"), "ts")
        time.sleep(1.1)  # the clock source ticks once a second
        X.stream_freshness(
            stream, expected, f"{folder}/state", f"{folder}/out", f"{folder}/checkpoint", "6 hours", "6 hours",
            clock=newest + timedelta(minutes=late),
        ).awaitTermination()
        report = spark.read.parquet(f"{folder}/out")
        last = report.filter(F.col("batch_id") == report.agg(F.max("batch_id")).scalar())
        part = f"{folder}/reports/minutes_later={late}"
        last.select("dataset", "rows_in_window", "state").write.parquet(part)
        out = f"{folder}/reports"
    return spark.read.parquet(out)
