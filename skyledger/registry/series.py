"""Rollups, series, counts, coverage and cadence."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions.numeric import TEMPERATURE_BANDS, circular_mean_deg, threshold_band
from skyledger.functions.time import chunk_start, format_ts, time_bucket
from skyledger.operators import aggregates as A
from skyledger.operators import filters as L
from skyledger.operators import rollups as U
from skyledger.operators import windows as W
from skyledger.registry.core import NOW_SQL, R, as_of, events, query, readings, rounded
from skyledger.spec import AIR, WEATHER

AIR_ROLLUP_SQL = ", ".join(f"round(avg({m}), 6) AS {m}_avg" for m in ("co", "no2", "o3", "pm10", "pm25", "so2"))
CIRCULAR_SQL = "degrees(atan2(avg(sin(radians(wind_dir_deg))), avg(cos(radians(wind_dir_deg)))))"
WEATHER_ROLLUP_SQL = f"""round(avg(temperature_c), 6) AS temp_avg_c, round(avg(humidity_pct), 6) AS humidity_avg,
  round(avg(pressure_hpa), 6) AS pressure_avg, round(max(precip_mm), 6) AS precip_max_mm,
  round({CIRCULAR_SQL}, 6) AS wind_avg_deg, round(avg(wind_speed_ms), 6) AS wind_avg_ms"""


def rollup_sql(columns: str, width: str, bucket: str) -> str:
    return (
        f"WITH {R} SELECT fiwareid, time_bucket(INTERVAL '{width}', ts) AS {bucket}, {columns} FROM r GROUP BY ALL"
    )


@query("rollup_air_daily", rollup_sql(AIR_ROLLUP_SQL, "1 day", "bucket_day"))
def _(spark, sf):
    return rounded(U.rollup(readings(spark, sf), AIR, "1 day"))


@query("rollup_air_weekly", rollup_sql(AIR_ROLLUP_SQL, "7 days", "bucket_week"))
def _(spark, sf):
    return rounded(U.rollup(readings(spark, sf), AIR, "7 days"))


@query("rollup_weather_daily", rollup_sql(WEATHER_ROLLUP_SQL, "1 day", "bucket_day"))
def _(spark, sf):
    return rounded(U.rollup(readings(spark, sf), WEATHER, "1 day"))


@query("rollup_weather_weekly", rollup_sql(WEATHER_ROLLUP_SQL, "7 days", "bucket_week"))
def _(spark, sf):
    return rounded(U.rollup(readings(spark, sf), WEATHER, "7 days"))


@query(
    "circular_mean_by_station",
    f"""WITH {R}, m AS (SELECT fiwareid, {CIRCULAR_SQL} AS d FROM r GROUP BY fiwareid)
    SELECT fiwareid, round(d, 6) AS wind_mean, round(CASE WHEN d < 0 THEN d + 360 ELSE d END, 6) AS wind_mean_360
    FROM m""",
)
def _(spark, sf):
    return rounded(
        readings(spark, sf)
        .groupBy("fiwareid")
        .agg(
            circular_mean_deg("wind_dir_deg").alias("wind_mean"),
            circular_mean_deg("wind_dir_deg", normalise=True).alias("wind_mean_360"),
        )
    )


@query(
    "time_buckets",
    """SELECT event_id, time_bucket(INTERVAL '1 hour', ts) AS hour, time_bucket(INTERVAL '1 day', ts) AS day,
      time_bucket(INTERVAL '7 days', ts) AS week FROM events""",
)
def _(spark, sf):
    return events(spark, sf).select(
        "event_id",
        time_bucket("1 hour", "ts").alias("hour"),
        time_bucket("1 day", "ts").alias("day"),
        time_bucket("7 days", "ts").alias("week"),
    )


@query(
    "chunk_sizes",
    """SELECT CAST(CAST(time_bucket(INTERVAL '7 days', ts) AS DATE) AS VARCHAR) AS chunk_start, count(*) AS row_count
    FROM events GROUP BY ALL""",
)
def _(spark, sf):
    return (
        events(spark, sf)
        .groupBy(chunk_start("ts").cast("string").alias("chunk_start"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "hourly_trend",
    f"""WITH {R} SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, round(avg(temperature_c), 6) AS avg_temp,
      round(avg(humidity_pct), 6) AS avg_humidity, round(avg(pressure_hpa), 6) AS avg_pressure
    FROM r WHERE ts > {NOW_SQL} - INTERVAL '24 hours' GROUP BY ALL ORDER BY hour""",
)
def _(spark, sf):
    metrics = {"avg_temp": "temperature_c", "avg_humidity": "humidity_pct", "avg_pressure": "pressure_hpa"}
    return rounded(U.hourly_trend(readings(spark, sf), metrics, as_of(spark, sf)))


WEATHER_DAILY_SQL = f"""{R}, d AS (SELECT fiwareid, time_bucket(INTERVAL '1 day', ts) AS bucket_day,
  avg(temperature_c) AS temp_avg_c, avg(humidity_pct) AS humidity_avg, avg(pressure_hpa) AS pressure_avg,
  max(precip_mm) AS precip_max_mm, {CIRCULAR_SQL} AS wind_avg_deg, avg(wind_speed_ms) AS wind_avg_ms
  FROM r GROUP BY ALL)"""
CLIMATE = ["temp_avg_c", "humidity_avg", "pressure_avg", "precip_max_mm", "wind_avg_deg", "wind_avg_ms"]


@query(
    "climatology",
    f"""WITH {WEATHER_DAILY_SQL} SELECT CAST(EXTRACT(DAY FROM bucket_day) AS INTEGER) AS day_of_month, fiwareid,
    {", ".join(f"CAST(round(CAST(printf('%.14e', avg({m})) AS DECIMAL(38, 15)), 2) AS DOUBLE) AS {m}" for m in CLIMATE)},
    count(*) AS years_of_data FROM d
    WHERE EXTRACT(MONTH FROM bucket_day) = 1 AND EXTRACT(DAY FROM bucket_day) BETWEEN 1 AND 8 GROUP BY ALL""",
)
def _(spark, sf):
    daily = U.rollup(readings(spark, sf), WEATHER, "1 day")
    out = U.climatology(daily, 1, 1, 8, CLIMATE)
    return out.select(*[F.col(c).cast("double").alias(c) if c in CLIMATE else c for c in out.columns])


@query(
    "daily_recent",
    f"""WITH {WEATHER_DAILY_SQL} SELECT bucket_day, fiwareid, round(temp_avg_c, 6) AS temp_avg_c,
      round(humidity_avg, 6) AS humidity_avg FROM d WHERE bucket_day > {NOW_SQL} - INTERVAL '7 days'
    ORDER BY bucket_day DESC, fiwareid""",
)
def _(spark, sf):
    # Only days inside the window can qualify, so older readings are not aggregated.
    now = as_of(spark, sf)
    recent = L.last_interval(readings(spark, sf), "ts", "7 days", now)
    daily = U.rollup(recent, WEATHER, "1 day")
    return rounded(U.daily_recent(daily, 7, now, ["temp_avg_c", "humidity_avg"]))


def long_series_sql(metric: str, interval: str) -> str:
    return f"""WITH {R} SELECT ts AS time, fiwareid AS metric, {metric} AS value FROM r
    WHERE ts >= {NOW_SQL} - INTERVAL '{interval}' AND {metric} IS NOT NULL ORDER BY ts"""


@query("temperature_series_day", long_series_sql("temperature_c", "24 hours"))
def _(spark, sf):
    return U.long_series(readings(spark, sf), "temperature_c", "24 hours", as_of(spark, sf))


@query("humidity_series_week", long_series_sql("humidity_pct", "7 days"))
def _(spark, sf):
    return U.long_series(readings(spark, sf), "humidity_pct", "7 days", as_of(spark, sf))


@query("pressure_series_week", long_series_sql("pressure_hpa", "7 days"))
def _(spark, sf):
    return U.long_series(readings(spark, sf), "pressure_hpa", "7 days", as_of(spark, sf))


@query("no2_series_week", long_series_sql("no2", "7 days"))
def _(spark, sf):
    return U.long_series(readings(spark, sf), "no2", "7 days", as_of(spark, sf))


TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "wide_series_hourly",
    f"""SELECT time_bucket(INTERVAL '1 hour', ts) AS time,
    {", ".join(f"round(max(CASE WHEN event_type = '{t}' THEN value END), 6) AS {t}" for t in TYPES)}
    FROM events GROUP BY ALL""",
)
def _(spark, sf):
    hourly = (
        events(spark, sf)
        .groupBy(time_bucket("1 hour", "ts").alias("time"), F.col("event_type").alias("metric"))
        .agg(F.max("value").alias("value"))
    )
    return rounded(U.wide_series(hourly, TYPES))


@query("row_count", "SELECT count(*) AS total_rows FROM events")
def _(spark, sf):
    return A.row_count(events(spark, sf))


RANGE = ("2024-01-08T00:00:00", "2024-01-15T12:00:00")
RANGE_SQL = f"ts >= TIMESTAMP '{RANGE[0].replace('T', ' ')}' AND ts < TIMESTAMP '{RANGE[1].replace('T', ' ')}'"


@query("row_count_range", f"SELECT count(*) AS total_rows FROM events WHERE {RANGE_SQL}")
def _(spark, sf):
    return A.row_count(events(spark, sf), "ts", *RANGE)


@query("scan_range", f"WITH {R} SELECT event_id, fiwareid, ts, no2, pm25 FROM r WHERE {RANGE_SQL}")
def _(spark, sf):
    return L.scan_range(readings(spark, sf), "ts", *RANGE).select("event_id", "fiwareid", "ts", "no2", "pm25")


@query(
    "last_interval_bounds",
    f"""SELECT 'inclusive' AS bound, count(*) AS row_count FROM events WHERE ts >= {NOW_SQL} - INTERVAL '24 hours'
    UNION ALL
    SELECT 'strict', count(*) FROM events WHERE ts > {NOW_SQL} - INTERVAL '24 hours'""",
)
def _(spark, sf):
    ev, now = events(spark, sf), as_of(spark, sf)
    parts = [
        L.last_interval(ev, "ts", "24 hours", now, strict=strict).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("bound"), "row_count"
        )
        for name, strict in (("inclusive", False), ("strict", True))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "avg_recent",
    f"""WITH {R} SELECT round(avg(temperature_c), 6) AS avg_temperature_c FROM r
    WHERE ts > {NOW_SQL} - INTERVAL '1 hour'""",
)
def _(spark, sf):
    return rounded(A.avg_recent(readings(spark, sf), "temperature_c", "1 hour", as_of(spark, sf)))


@query(
    "not_null_and_require",
    f"""WITH {R} SELECT event_id, no2, pm25 FROM r WHERE no2 IS NOT NULL AND pm25 IS NOT NULL""",
)
def _(spark, sf):
    rows = L.require_metric(L.not_null(readings(spark, sf), "no2"), "pm25")
    return rows.select("event_id", "no2", "pm25")


@query(
    "station_filters",
    f"""WITH {R} SELECT event_id, fiwareid, ts, no2 FROM r WHERE fiwareid = 'S7'
    UNION ALL SELECT event_id, fiwareid, ts, no2 FROM r WHERE fiwareid LIKE '%S1_'""",
)
def _(spark, sf):
    rows = readings(spark, sf).select("event_id", "fiwareid", "ts", "no2")
    return L.station_eq(rows, "S7").unionByName(L.station_like(rows, "%S1_"))


@query("contains_ci", "SELECT event_id, event_type FROM events WHERE contains(lower(event_type), 'ick')")
def _(spark, sf):
    return L.contains_ci(events(spark, sf), "event_type", "ICK").select("event_id", "event_type")


@query(
    "calendar_filter",
    "SELECT event_id, ts FROM events WHERE EXTRACT(MONTH FROM ts) = 1 AND EXTRACT(DAY FROM ts) BETWEEN 3 AND 5",
)
def _(spark, sf):
    return L.calendar_filter(events(spark, sf), "ts", 1, 3, 5).select("event_id", "ts")


@query(
    "id_range",
    "SELECT event_id, user_id FROM events WHERE user_id BETWEEN 12 AND 22 AND user_id IN (12, 15, 22, 30)",
)
def _(spark, sf):
    return L.id_range(events(spark, sf), "user_id", 12, 22, [12, 15, 22, 30]).select("event_id", "user_id")


@query(
    "distinct_stations_by_day",
    f"""WITH {R} SELECT time_bucket(INTERVAL '1 day', ts) AS snapshot, count(DISTINCT fiwareid) AS stations
    FROM r GROUP BY ALL""",
)
def _(spark, sf):
    rows = readings(spark, sf).withColumn("snapshot", time_bucket("1 day", "ts"))
    return A.distinct_stations(rows, "fiwareid", ["snapshot"])


@query("distinct_stations", "SELECT count(DISTINCT user_id) AS stations FROM events")
def _(spark, sf):
    return A.distinct_stations(readings(spark, sf))


@query(
    "snapshot_tick",
    """WITH t AS (SELECT event_type AS dataset, time_bucket(INTERVAL '1 hour', ts) AS tick FROM events)
    SELECT dataset, max(tick) AS max_tick, count(DISTINCT tick) AS tick_count, count(*) AS row_count,
      count(DISTINCT tick) > 1 AS mixed FROM t GROUP BY dataset""",
)
def _(spark, sf):
    ticks = events(spark, sf).select(F.col("event_type").alias("dataset"), time_bucket("1 hour", "ts").alias("ts"))
    return A.snapshot_tick(ticks, "dataset")


@query(
    "snapshot_ticks",
    """SELECT DISTINCT event_type AS dataset, time_bucket(INTERVAL '1 hour', ts) AS tick FROM events""",
)
def _(spark, sf):
    ticks = events(spark, sf).select(F.col("event_type").alias("dataset"), time_bucket("1 hour", "ts").alias("ts"))
    return A.snapshot_ticks(ticks, "dataset")


@query(
    "max_ts_or_default",
    "SELECT coalesce(strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ'), '1970-01-01T00:00:00Z') AS max_ts FROM events",
)
def _(spark, sf):
    return A.max_ts_or_default(events(spark, sf))


@query("latest_ts_by_dataset", "SELECT event_type, max(ts) AS last_ts FROM events GROUP BY event_type")
def _(spark, sf):
    return A.latest_ts(events(spark, sf), "ts", "event_type")


AIR_METRICS = list(AIR.metrics)


@query(
    "metric_coverage_rows",
    f"""WITH {R}, c AS (SELECT count(*) AS total, {", ".join(f"count({m}) AS {m}" for m in AIR_METRICS)} FROM r),
    u AS (UNPIVOT c ON {", ".join(AIR_METRICS)} INTO NAME metric VALUE with_value)
    SELECT metric, with_value, total, round(with_value * 100.0e0 / total, 6) AS percent FROM u""",
)
def _(spark, sf):
    return rounded(A.metric_coverage(readings(spark, sf), AIR_METRICS))


@query(
    "metric_coverage_stations",
    f"""WITH {R}, s AS (SELECT fiwareid, {", ".join(f"max({m}) AS {m}" for m in AIR_METRICS)} FROM r GROUP BY 1),
    c AS (SELECT count(*) AS total, {", ".join(f"count({m}) AS {m}" for m in AIR_METRICS)} FROM s),
    u AS (UNPIVOT c ON {", ".join(AIR_METRICS)} INTO NAME metric VALUE with_value)
    SELECT metric, with_value, total, round(with_value * 100.0e0 / total, 6) AS percent FROM u""",
)
def _(spark, sf):
    return rounded(A.metric_coverage(readings(spark, sf), AIR_METRICS, "fiwareid"))


@query(
    "coverage_matrix",
    f"""WITH {R} SELECT fiwareid, {", ".join(f"count({m}) > 0 AS {m}" for m in AIR_METRICS)} FROM r GROUP BY 1""",
)
def _(spark, sf):
    return A.coverage_matrix(readings(spark, sf), AIR_METRICS)


GAPS_SQL = """t AS (SELECT DISTINCT event_type AS dataset, ts FROM events),
  g AS (SELECT dataset, ts, lag(ts) OVER (PARTITION BY dataset ORDER BY ts) AS previous_ts FROM t),
  gaps AS (SELECT dataset, ts, previous_ts, (epoch_us(ts) - epoch_us(previous_ts)) / 3.6e9 AS gap_hours
           FROM g WHERE previous_ts IS NOT NULL)"""


def _gaps(spark, sf):
    ticks = events(spark, sf).select(F.col("event_type").alias("dataset"), "ts")
    return W.tick_gaps(ticks, "dataset")


@query("tick_gaps", f"WITH {GAPS_SQL} SELECT dataset, ts, previous_ts, round(gap_hours, 6) AS gap_hours FROM gaps")
def _(spark, sf):
    return rounded(_gaps(spark, sf))


@query(
    "gap_summary",
    f"""WITH {GAPS_SQL} SELECT dataset, count(*) AS advances, round(avg(gap_hours), 6) AS mean_hours,
      round(min(gap_hours), 6) AS min_hours, round(max(gap_hours), 6) AS max_hours FROM gaps GROUP BY dataset""",
)
def _(spark, sf):
    return rounded(A.gap_summary(_gaps(spark, sf), "dataset"))


@query(
    "count_between",
    """SELECT event_type, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20')
      AS row_count FROM events GROUP BY event_type""",
)
def _(spark, sf):
    return A.count_between(events(spark, sf), "event_type", "ts", "2024-01-05T10:00:00", "2024-01-20T10:00:00",
                           expected=events(spark, sf).select("event_type"))


@query(
    "active_datasets",
    f"""SELECT event_type, count(*) AS last_20_days FROM events
    WHERE ts >= date_trunc('day', {NOW_SQL}) - INTERVAL '20 days' AND ts < date_trunc('day', {NOW_SQL})
    GROUP BY event_type HAVING count(*) > 0""",
)
def _(spark, sf):
    return A.active_datasets(events(spark, sf), "event_type", "ts", as_of(spark, sf), 20)


@query(
    "delivery_stats",
    """SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
      count(*) FILTER (WHERE event_type <> 'error') AS success, count(*) FILTER (WHERE event_type = 'error') AS failure,
      count(*) AS total, round(count(*) FILTER (WHERE event_type = 'error') / CAST(count(*) AS DOUBLE), 6)
      AS failure_ratio FROM events GROUP BY 1""",
)
def _(spark, sf):
    return rounded(A.delivery_stats(events(spark, sf), F.col("event_type") == "error"))


COUNTER_SQL = """s AS (SELECT event_type, ts, CAST(max(event_id % 1000) AS DOUBLE) AS value FROM events GROUP BY 1, 2),
  p AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts) AS last_value,
               lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS last_ts FROM s),
  d AS (SELECT *, CASE WHEN value < last_value THEN value ELSE value - last_value END AS step FROM p),
  f AS (SELECT event_type, ts, value,
     coalesce(sum(step) OVER w, 0) - coalesce(first_value(step) OVER w, 0) AS increase FROM d
     WINDOW w AS (PARTITION BY event_type ORDER BY epoch_us(ts)
                  RANGE BETWEEN 7199999999 PRECEDING AND CURRENT ROW))"""


def _counters(spark, sf):
    return events(spark, sf).select("event_type", "ts", (F.col("event_id") % 1000).cast("double").alias("value"))


@query("counter_increase", f"WITH {COUNTER_SQL} SELECT event_type, ts, value, round(increase, 6) AS increase FROM f")
def _(spark, sf):
    return rounded(A.counter_increase(_counters(spark, sf), "2 hours", ["event_type"]))


@query("counter_rate", f"WITH {COUNTER_SQL} SELECT event_type, ts, value, round(increase / 7200.0e0, 6) AS rate FROM f")
def _(spark, sf):
    return rounded(A.counter_rate(_counters(spark, sf), "2 hours", ["event_type"]))


@query(
    "temperature_bands",
    f"""WITH {R} SELECT event_id, temperature_c, CASE WHEN temperature_c IS NULL THEN NULL
      WHEN temperature_c >= 35 THEN 'red' WHEN temperature_c >= 30 THEN 'orange' WHEN temperature_c >= 25 THEN 'yellow'
      WHEN temperature_c >= 10 THEN 'green' ELSE 'blue' END AS band FROM r""",
)
def _(spark, sf):
    band = threshold_band("temperature_c", TEMPERATURE_BANDS)
    return readings(spark, sf).select("event_id", "temperature_c", band.alias("band"))


@query(
    "wire_instants",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS wire_ts FROM events",
)
def _(spark, sf):
    return events(spark, sf).select("event_id", format_ts("ts").alias("wire_ts"))
