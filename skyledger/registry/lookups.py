"""Latest rows, top-k, places, station lookups, advances, alerts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions.geo import CENTRE_POINT, HOME_POINT, ellipsoid_m, generated_geo, haversine_m, point_or_geometry
from skyledger.functions.time import time_bucket
from skyledger.operators import geo as G
from skyledger.operators import joins as J
from skyledger.operators import order as O
from skyledger.operators import quality as Q
from skyledger.operators import reports as P
from skyledger.operators import windows as W
from skyledger.operators.changes import upsert_dimension
from skyledger.plans.ingest import unmatched_names
from skyledger.session import literal_table
from skyledger.registry.core import (
    NOW_SQL,
    R,
    as_of,
    ellipsoid_sql,
    events,
    haversine_sql,
    query,
    readings,
    rounded,
)
from skyledger.stations import (
    DROPPED_IDS,
    ELEVATIONS,
    HISTORICAL_PLACES,
    RETIRED_IDS,
    STATIONS,
    historical_names,
    retired_ids,
    station_dimension,
)

WEATHER_NOW = ["temperature_c", "humidity_pct", "pressure_hpa", "wind_speed_ms", "wind_dir_deg", "precip_mm"]


@query(
    "latest_per_station",
    f"""WITH {R} SELECT DISTINCT ON (fiwareid) fiwareid, ts, {", ".join(WEATHER_NOW)} FROM r
    ORDER BY fiwareid, ts DESC""",
)
def _(spark, sf):
    return W.latest_per_station(readings(spark, sf), cols=WEATHER_NOW)


@query(
    "latest_air_per_station",
    f"""WITH {R} SELECT DISTINCT ON (fiwareid) fiwareid, ts, no2, o3, pm25, air_quality_summary FROM r
    ORDER BY fiwareid, ts DESC""",
)
def _(spark, sf):
    return W.latest_per_station(readings(spark, sf), cols=["no2", "o3", "pm25", "air_quality_summary"])


@query(
    "last_not_null",
    f"""WITH {R} SELECT fiwareid, arg_max(temperature_c, ts) AS temperature_c, max(ts) AS ts FROM r
    WHERE temperature_c IS NOT NULL GROUP BY fiwareid""",
)
def _(spark, sf):
    return W.last_not_null(readings(spark, sf), "temperature_c", "ts", ["fiwareid"])


@query(
    "latest_readings",
    f"""WITH {R} SELECT ts, fiwareid, temperature_c, humidity_pct, wind_speed_ms FROM r
    ORDER BY ts DESC, fiwareid LIMIT 5""",
)
def _(spark, sf):
    return O.latest_n(readings(spark, sf), "ts", 5, ["temperature_c", "humidity_pct", "wind_speed_ms"])


@query(
    "latest_readings_of_station",
    f"""WITH {R} SELECT ts, fiwareid, no2 FROM r WHERE fiwareid = 'S3' ORDER BY ts DESC, fiwareid LIMIT 5""",
)
def _(spark, sf):
    return O.latest_n(readings(spark, sf), "ts", 5, ["no2"], station="S3")


@query(
    "nulls_last_order",
    """SELECT DISTINCT CASE WHEN user_id % 7 <> 0 THEN user_id % 50 END AS oid, user_id FROM events
    ORDER BY oid ASC NULLS LAST, user_id""",
)
def _(spark, sf):
    stations = (
        events(spark, sf)
        .select(F.when(F.col("user_id") % 7 != 0, F.col("user_id") % 50).alias("oid"), "user_id")
        .distinct()
    )
    return O.sort_nulls_last(stations, "oid", ["user_id"])


@query(
    "readings_in_time_order",
    f"""WITH {R} SELECT ts, fiwareid, no2 FROM r WHERE no2 IS NOT NULL ORDER BY ts, fiwareid""",
)
def _(spark, sf):
    rows = readings(spark, sf).filter(F.col("no2").isNotNull()).select("ts", "fiwareid", "no2")
    return O.order_by_ts(rows)


HOME_SQL = haversine_sql(str(HOME_POINT[0]) + "e0", str(HOME_POINT[1]) + "e0", "lat", "lon")


@query(
    "nearest_stations",
    f"""WITH {R}, s AS (SELECT DISTINCT fiwareid, lat, lon FROM r)
    SELECT fiwareid, lat, lon, round({HOME_SQL}, 4) AS distance_meters FROM s
    ORDER BY {HOME_SQL}, fiwareid LIMIT 10""",
)
def _(spark, sf):
    stations = readings(spark, sf).select("fiwareid", "lat", "lon").distinct()
    return rounded(G.k_nearest(stations, *HOME_POINT, 10), ["distance_meters"], 4)


@query(
    "distances_from_home",
    f"""WITH {R} SELECT event_id, round({HOME_SQL}, 4) AS sphere_m,
      round({ellipsoid_sql(str(HOME_POINT[0]) + "e0", str(HOME_POINT[1]) + "e0", "lat", "lon")}, 4) AS spheroid_m
    FROM r""",
)
def _(spark, sf):
    return rounded(
        readings(spark, sf).select(
            "event_id",
            haversine_m(*HOME_POINT, "lat", "lon").alias("sphere_m"),
            ellipsoid_m(*HOME_POINT, "lat", "lon").alias("spheroid_m"),
        ),
        places=4,
    )


def within_sql(point: tuple[float, float], metres: int, distance, cols: str = "fiwareid") -> str:
    metres_sql = distance("lat", "lon", f"{point[0]}e0", f"{point[1]}e0")
    return f"WITH {R} SELECT DISTINCT {cols} FROM r WHERE {metres_sql} <= {metres}"


@query("stations_within_1km", within_sql(HOME_POINT, 1000, ellipsoid_sql))
def _(spark, sf):
    return G.stations_within(readings(spark, sf), *HOME_POINT, 1000)


@query("stations_within_3km", within_sql(CENTRE_POINT, 3000, ellipsoid_sql, "fiwareid, lat, lon"))
def _(spark, sf):
    return G.stations_within(readings(spark, sf), *CENTRE_POINT, 3000, cols=["fiwareid", "lat", "lon"])


@query("stations_within_3km_sphere", within_sql(HOME_POINT, 3000, haversine_sql))
def _(spark, sf):
    return G.stations_within(readings(spark, sf), *HOME_POINT, 3000, model="sphere")


@query(
    "valid_places",
    """WITH g AS (SELECT event_id, user_id,
      CASE WHEN user_id % 4 > 0 THEN user_id % 200 - 100e0 END AS p_lat, CASE WHEN user_id % 4 > 0 THEN 10e0 END AS p_lon,
      30e0 + user_id % 9 AS g_lat, user_id % 400 - 200e0 AS g_lon FROM events),
    c AS (SELECT event_id, CASE WHEN user_id % 4 > 0 THEN p_lat WHEN user_id % 4 = 0 THEN g_lat END AS lat,
      CASE WHEN user_id % 4 > 0 THEN p_lon ELSE g_lon END AS lon FROM g)
    SELECT event_id, lat, lon FROM c WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180""",
)
def _(spark, sf):
    uid = F.col("user_id")
    point = F.when(uid % 4 > 0, F.struct((uid % 200 - F.lit(100.0)).alias("lat"), F.lit(10.0).alias("lon")))
    geometry = F.struct(F.array(uid % 400 - F.lit(200.0), F.lit(30.0) + uid % 9).alias("coordinates"))
    shaped = events(spark, sf).select("event_id", point.alias("point"), geometry.alias("geometry"))
    lat, lon = point_or_geometry("point", "geometry")
    return shaped.select("event_id", lat.alias("lat"), lon.alias("lon")).filter(F.col("lat").isNotNull())


@query(
    "generated_places",
    f"""WITH {R} SELECT event_id, CASE WHEN no2 IS NOT NULL AND pm25 IS NOT NULL THEN no2 END AS geo_lat,
      CASE WHEN no2 IS NOT NULL AND pm25 IS NOT NULL THEN pm25 END AS geo_lon FROM r""",
)
def _(spark, sf):
    geo = generated_geo("no2", "pm25")
    return readings(spark, sf).select("event_id", geo["lat"].alias("geo_lat"), geo["lon"].alias("geo_lon"))


# History rows take their station name from the user number, so every row of the table is one of six stations.
NAMES = ["Viveros", "Bulevard Sud", "Nazaret Meteo", "Conselleria Meteo", "Politecnico", "Avda. Francia"]
NAME_SQL = "CASE user_id % 6 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES)) + " END"


def named_history(spark, sf):
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("user_id") % 6 + 1).cast("int"))
    return events(spark, sf).withColumn("estacion", name)


def names_sql(station_type: str) -> str:
    places = {n: (lat, lon) for n, lat, lon in HISTORICAL_PLACES}
    rows = [(s[3], s[0], *places[s[3]]) for s in STATIONS if s[1] == station_type and s[3]]
    body = ", ".join(f"('{n}', '{i}', {lat}e0, {lon}e0)" for n, i, lat, lon in rows)
    return f"n(estacion, fiwareid, lat, lon) AS (VALUES {body})"


@query(
    "map_air_station_ids",
    f"""WITH {names_sql("air")}, h AS (SELECT event_id, {NAME_SQL} AS estacion FROM events)
    SELECT event_id, estacion, fiwareid, lat, lon FROM h JOIN n USING (estacion)""",
)
def _(spark, sf):
    mapped, _ = J.map_station_ids(named_history(spark, sf), historical_names(spark, "air"))
    return mapped.select("event_id", "estacion", "fiwareid", "lat", "lon")


@query(
    "map_weather_station_ids",
    f"""WITH {names_sql("weather")}, h AS (SELECT event_id, {NAME_SQL} AS estacion FROM events)
    SELECT event_id, estacion, fiwareid, lat, lon FROM h JOIN n USING (estacion)""",
)
def _(spark, sf):
    mapped, _ = J.map_station_ids(named_history(spark, sf), historical_names(spark, "weather"))
    return mapped.select("event_id", "estacion", "fiwareid", "lat", "lon")


@query(
    "unmatched_station_names",
    f"""WITH {names_sql("air")}, h AS (SELECT event_id, {NAME_SQL} AS estacion FROM events)
    SELECT estacion, count(*) AS rows FROM h ANTI JOIN n USING (estacion) GROUP BY estacion""",
)
def _(spark, sf):
    return unmatched_names(named_history(spark, sf), historical_names(spark, "air"))


OLD_IDS = [RETIRED_IDS[0][0], RETIRED_IDS[0][1], *DROPPED_IDS, "W01_AVFRANCIA_10m"]
OLD_SQL = "CASE user_id % 5 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(OLD_IDS)) + " END"


@query(
    "consolidate_station_ids",
    f"""WITH h AS (SELECT event_id, {OLD_SQL} AS fiwareid FROM events)
    SELECT event_id, CASE fiwareid WHEN '{RETIRED_IDS[0][0]}' THEN '{RETIRED_IDS[0][1]}' ELSE fiwareid END AS fiwareid
    FROM h WHERE fiwareid NOT IN ({", ".join(f"'{i}'" for i in DROPPED_IDS)})""",
)
def _(spark, sf):
    old = F.element_at(F.array(*[F.lit(i) for i in OLD_IDS]), (F.col("user_id") % 5 + 1).cast("int"))
    rows = events(spark, sf).select("event_id", old.alias("fiwareid"))
    return J.consolidate_station_ids(rows, retired_ids(spark), DROPPED_IDS).select("event_id", "fiwareid")


@query(
    "station_coord_match",
    f"""WITH {R}, a AS (SELECT DISTINCT fiwareid, lat, lon FROM r),
    b AS (SELECT DISTINCT 'H' || user_id AS historical_id, lat + user_id % 3 * 2e-3 AS r_lat,
            lon - user_id % 4 * 1e-3 AS r_lon FROM r),
    d AS (SELECT fiwareid, historical_id, {haversine_sql("lat", "lon", "r_lat", "r_lon")} AS m FROM a, b
          WHERE abs(lat - r_lat) < 0.01 AND abs(lon - r_lon) < 0.01)
    SELECT DISTINCT ON (fiwareid) fiwareid, historical_id, round(m, 4) AS distance_m FROM d WHERE m <= 300
    ORDER BY fiwareid, m, historical_id""",
)
def _(spark, sf):
    rows = readings(spark, sf)
    left = rows.select("fiwareid", "lat", "lon").distinct()
    right = rows.select(
        F.concat(F.lit("H"), F.col("user_id").cast("string")).alias("historical_id"),
        (F.col("lat") + F.col("user_id") % 3 * F.lit(2e-3)).alias("lat"),
        (F.col("lon") - F.col("user_id") % 4 * F.lit(1e-3)).alias("lon"),
    ).distinct()
    return rounded(J.station_coord_match(left, right, 300), ["distance_m"], 4)


@query(
    "distinct_ids_union",
    """SELECT DISTINCT id AS dataset_id FROM (SELECT event_type AS id FROM events UNION ALL
      SELECT source FROM documents UNION ALL SELECT role FROM conversations)""",
)
def _(spark, sf):
    return O.distinct_ids_union(
        events(spark, sf).select(F.col("event_type").alias("dataset_id")),
        spark.read.parquet(f"{sf}/documents.parquet").select(F.col("source").alias("dataset_id")),
        spark.read.parquet(f"{sf}/conversations.parquet").select(F.col("role").alias("dataset_id")),
    )


@query(
    "both_datasets",
    f"""WITH {R} SELECT event_id, fiwareid, 'air' AS dataset, no2, pm25, NULL::DOUBLE AS temperature_c FROM r
    UNION ALL SELECT event_id, fiwareid, 'weather', NULL, NULL, temperature_c FROM r""",
)
def _(spark, sf):
    rows = readings(spark, sf)
    return O.both_datasets(
        rows.select("event_id", "fiwareid", "no2", "pm25"), rows.select("event_id", "fiwareid", "temperature_c")
    )


@query(
    "upsert_dimension",
    f"""WITH {R}, o AS (SELECT fiwareid, 'old' AS station_type, min(ts) AS first_ts, max(pm25) AS top FROM r
      WHERE event_type <> 'error' AND user_id % 3 > 0 GROUP BY 1),
    n AS (SELECT fiwareid, 'new' AS station_type, min(ts) AS first_ts, max(no2) AS top FROM r GROUP BY 1)
    SELECT fiwareid, coalesce(o.station_type, n.station_type) AS station_type,
      CASE WHEN n.fiwareid IS NOT NULL THEN n.first_ts ELSE o.first_ts END AS first_ts,
      CASE WHEN n.fiwareid IS NOT NULL THEN n.top ELSE o.top END AS top
    FROM o FULL JOIN n USING (fiwareid)""",
)
def _(spark, sf):
    rows = readings(spark, sf)
    old = (
        rows.filter((F.col("event_type") != "error") & (F.col("user_id") % 3 > 0))
        .groupBy("fiwareid")
        .agg(F.lit("old").alias("station_type"), F.min("ts").alias("first_ts"), F.max("pm25").alias("top"))
    )
    new = rows.groupBy("fiwareid").agg(
        F.lit("new").alias("station_type"), F.min("ts").alias("first_ts"), F.max("no2").alias("top")
    )
    return upsert_dimension(old, new, "fiwareid", ["first_ts", "top"])


# A poll an hour: each station shows its newest tick, some of them running up to two hours late.
POLLS_SQL = """s AS (SELECT epoch_ms(ts) // 3600000 AS poll_seq, 'S' || user_id AS fiwareid,
    max(time_bucket(INTERVAL '1 hour', ts) - to_hours(CAST(event_id % 3 AS INTEGER))) AS ts FROM events GROUP BY 1, 2)"""


def polls(ev):
    late = F.make_interval(hours=(F.col("event_id") % 3).cast("int"))
    return ev.select(
        F.floor(F.unix_seconds("ts") / 3600).cast("long").alias("poll_seq"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("fiwareid"),
        (time_bucket("1 hour", "ts") - late).alias("ts"),
    )


ADVANCES_SQL = f"""WITH {POLLS_SQL},
  p AS (SELECT poll_seq, max(ts) AS max_tick FROM s GROUP BY 1),
  q AS (SELECT *, coalesce(max_tick > max(max_tick) OVER (ORDER BY poll_seq ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), true) AS resets FROM p),
  x AS (SELECT s.*, max_tick, resets, sum(CASE WHEN resets THEN 1 ELSE 0 END) OVER (PARTITION BY fiwareid
          ORDER BY poll_seq) AS seg FROM s JOIN q USING (poll_seq)),
  y AS (SELECT *, max(ts) OVER (PARTITION BY fiwareid, seg ORDER BY poll_seq ROWS BETWEEN UNBOUNDED PRECEDING
          AND CURRENT ROW) AS top FROM x),
  z AS (SELECT *, lag(top) OVER (PARTITION BY fiwareid ORDER BY poll_seq) AS last_seen FROM y),
  a AS (SELECT *, last_seen IS NULL OR ts > last_seen AS advanced FROM z)
  SELECT poll_seq, fiwareid, ts, max_tick, last_seen, advanced, CASE WHEN resets THEN 'DATASET ADVANCE'
    WHEN bool_or(advanced) OVER (PARTITION BY poll_seq) THEN 'PARTIAL ADVANCE' ELSE 'NONE' END AS poll_kind FROM a"""


@query("station_advances", ADVANCES_SQL)
def _(spark, sf):
    # Hundreds of polls per block keep blocks many even for a month of hourly polls.
    return W.station_advances(polls(events(spark, sf)), block=168)


@query(
    "alert_sustained",
    """WITH s AS (SELECT event_type, ts, max(value) AS value FROM events GROUP BY 1, 2),
    m AS (SELECT *, max(CASE WHEN NOT value > 20 THEN ts END) OVER (PARTITION BY event_type ORDER BY ts) AS broken
          FROM s)
    SELECT event_type, min(ts) AS since, max(ts) AS until, count(*) AS samples,
      round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS held_seconds,
      (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 >= 3600 AS firing
    FROM m WHERE value > 20 GROUP BY event_type, broken""",
)
def _(spark, sf):
    samples = events(spark, sf).groupBy("event_type", "ts").agg(F.max("value").alias("value"))
    return rounded(W.alert_sustained(samples, F.col("value") > 20, "1 hour", ["event_type"]), ["held_seconds"])


@query(
    "freshness",
    f"""WITH c AS (SELECT event_type AS dataset, count(*) FILTER (WHERE ts > {NOW_SQL} - INTERVAL '5 minutes') AS n FROM events
      WHERE ts > {NOW_SQL} - INTERVAL '20 minutes' GROUP BY 1)
    SELECT dataset, coalesce(n, 0) AS rows_in_window,
      CASE WHEN n > 0 THEN 'ok' WHEN n IS NOT NULL THEN 'pending' ELSE 'firing' END AS state
    FROM (SELECT DISTINCT event_type AS dataset FROM events) LEFT JOIN c USING (dataset)""",
)
def _(spark, sf):
    rows = events(spark, sf).select(F.col("event_type").alias("dataset"), "ts")
    expected = rows.select("dataset").distinct()
    return Q.freshness(rows, expected, as_of(spark, sf), "5 minutes", "15 minutes")


def _alerts(spark, sf):
    severity = F.when(F.col("value") > 150, "critical").when(F.col("value") > 30, "warning")
    return (
        events(spark, sf)
        .select(
            F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("alertname"),
            severity.alias("severity"),
            "ts",
            "event_id",
        )
        .filter(F.col("severity").isNotNull())
    )


ALERTS_SQL = """a AS (SELECT event_type || '-' || user_id AS alertname, CASE WHEN value > 150 THEN 'critical'
  ELSE 'warning' END AS severity, ts, event_id FROM events WHERE value > 30)"""


@query(
    "group_alerts",
    f"""WITH {ALERTS_SQL} SELECT alertname, severity, count(*) AS alerts, min(ts) AS first_ts, max(ts) AS last_ts
    FROM a GROUP BY ALL""",
)
def _(spark, sf):
    return Q.group_alerts(_alerts(spark, sf))


@query(
    "inhibit_alerts",
    f"""WITH {ALERTS_SQL} SELECT alertname, severity, event_id FROM a WHERE severity = 'critical'
      OR alertname NOT IN (SELECT alertname FROM a WHERE severity = 'critical')""",
)
def _(spark, sf):
    return Q.inhibit(_alerts(spark, sf)).select("alertname", "severity", "event_id")


REPORT_METRICS = ["viento_vel", "temperatur", "extra"]


@query(
    "station_report",
    """WITH l AS (SELECT event_id, 'viento_vel' AS metric, CASE WHEN event_type = 'click' THEN value END AS value FROM events
      UNION ALL SELECT event_id, 'temperatur', CASE WHEN event_type = 'view' THEN value END FROM events
      UNION ALL SELECT event_id, 'extra', value FROM events)
    SELECT event_id, metric, value, CASE metric WHEN 'viento_vel' THEN 'Wind Spd' WHEN 'temperatur' THEN 'Temp'
      ELSE metric END AS label,
      CASE metric WHEN 'viento_vel' THEN 'm/s' WHEN 'temperatur' THEN '°C' ELSE '' END AS unit,
      CASE WHEN value IS NULL THEN 'null' ELSE rtrim(CAST(CAST(round(CAST(CAST(value AS VARCHAR) AS DECIMAL(18, 4)), 1)
        AS DECIMAL(18, 1)) AS VARCHAR) || ' ' ||
        CASE metric WHEN 'viento_vel' THEN 'm/s' WHEN 'temperatur' THEN '°C' ELSE '' END) END AS shown FROM l""",
)
def _(spark, sf):
    rows = readings(spark, sf).select(
        "event_id",
        F.col("wind_speed_ms").alias("viento_vel"),
        F.col("temperature_c").alias("temperatur"),
        F.col("value").alias("extra"),
    )
    return P.station_report(rows, REPORT_METRICS, P.catalogue(spark, P.WEATHER_CATALOGUE), ["event_id"])


@query(
    "station_list",
    f"""WITH {R} SELECT DISTINCT CASE WHEN user_id % 7 <> 0 THEN user_id END AS objectid, fiwareid,
      replace(replace('ESTACIÓN JARDINES DE ' || fiwareid, 'ESTACIÓN', 'EST.'), 'JARDINES DE ', 'JD ') AS nombre,
      CASE WHEN user_id % 5 <> 0 THEN lat END AS lat, CASE WHEN user_id % 5 <> 0 THEN lon END AS lon FROM r""",
)
def _(spark, sf):
    stations = (
        readings(spark, sf)
        .select(
            F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("objectid"),
            "fiwareid",
            F.concat(F.lit("ESTACIÓN JARDINES DE "), "fiwareid").alias("nombre"),
            F.when(F.col("user_id") % 5 != 0, F.col("lat")).alias("lat"),
            "lon",
        )
        .distinct()
    )
    listed = P.station_list(stations, ["objectid", "fiwareid", "nombre"])
    return listed.select(
        "objectid",
        "fiwareid",
        P.short_name("nombre").alias("nombre"),
        F.col("place.lat").alias("lat"),
        F.col("place.lon").alias("lon"),
    )


@query(
    "sea_level_pressure",
    f"""WITH e(fiwareid, elevation_m) AS (VALUES {", ".join(f"('{i}', {m}e0)" for i, m in ELEVATIONS)}),
    h AS (SELECT event_id, {OLD_SQL} AS fiwareid, 950 + value / 10 AS pressure_hpa FROM events)
    SELECT event_id, fiwareid, round(pressure_hpa * exp(9.80665e0 * 0.0289644e0 / 8.31446e0 * elevation_m / 288.15e0), 6)
      AS pressure_slp_hpa FROM h LEFT JOIN e USING (fiwareid)""",
)
def _(spark, sf):
    ids = F.element_at(F.array(*[F.lit(i) for i in OLD_IDS]), (F.col("user_id") % 5 + 1).cast("int"))
    rows = events(spark, sf).select(
        "event_id", ids.alias("fiwareid"), (F.lit(950.0) + F.col("value") / 10).alias("pressure_hpa")
    )
    heights = literal_table(spark, ELEVATIONS, "fiwareid string, elevation_m double")
    return rounded(P.with_sea_level_pressure(rows, heights).select("event_id", "fiwareid", "pressure_slp_hpa"))


@query(
    "readings_with_station_names",
    f"""WITH {names_sql("air")}, d(fiwareid, display_name) AS (VALUES
      {", ".join(f"('{s[0]}', '{s[2]}')" for s in STATIONS if s[1] == "air")}),
    h AS (SELECT event_id, value, {NAME_SQL} AS estacion FROM events)
    SELECT display_name, count(*) AS row_count, round(avg(value), 6) AS mean_value
    FROM h JOIN n USING (estacion) JOIN d USING (fiwareid) GROUP BY display_name""",
)
def _(spark, sf):
    mapped, _ = J.map_station_ids(named_history(spark, sf), historical_names(spark, "air"))
    named = mapped.join(station_dimension(spark).select("fiwareid", "display_name"), "fiwareid")
    return rounded(
        named.groupBy("display_name").agg(F.count(F.lit(1)).alias("row_count"), F.avg("value").alias("mean_value"))
    )
