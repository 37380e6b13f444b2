"""Parsing, normalising, validating, change capture and landed files."""

from __future__ import annotations

import contextlib
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.geo import extract_lat_lon
from skyledger.functions.numeric import parse_float_or_null
from skyledger.functions.once import spread
from skyledger.functions.time import combine_date_time, normalise_ts, parse_datetime_any
from skyledger.operators import filters as L
from skyledger.operators import normalise as N
from skyledger.operators import quality as Q
from skyledger.operators.changes import dedup_batch, emit_changes
from skyledger.operators.joins import anti_seen
from skyledger.plans.ingest import backfill, poll, replay, replay_slices
from skyledger.registry.core import R, events, query, readings, when_type
from skyledger.registry.lookups import NAME_SQL, named_history, names_sql
from skyledger.session import literal_table, work_dir
from skyledger.sources import records as S
from skyledger.sources.exports import export_dataset, topk_payload
from skyledger.operators.geo import k_nearest
from skyledger.functions.geo import HOME_POINT
from skyledger.registry.core import haversine_sql
from skyledger.spec import AIR, WEATHER
from skyledger.stations import historical_names


# Rows of one landed file of lines, about 80 MB.
FILE_ROWS = 500_000


def eid() -> Column:
    return F.col("event_id")


def uid() -> Column:
    return F.col("user_id")


def seq_as_id() -> Column:
    return F.col("_seq").alias("event_id")


def iso(ts: Column | str, tail: str = "") -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(tail))


def raw_instant() -> Column:
    """The instant in the spellings the portal uses; some are missing."""
    shifted = F.col("ts") + F.expr("INTERVAL 2 HOURS")
    return (
        F.when(eid() % 16 == 3, F.lit(None).cast("string"))
        .when(eid() % 4 == 0, iso("ts", "Z"))
        .when(eid() % 4 == 1, iso(shifted, "+02:00"))
        .when(eid() % 4 == 2, iso("ts", ".500Z"))
        .otherwise(iso("ts"))
    )


def raw_station() -> Column:
    return F.when(uid() % 5 == 0, F.lit(None).cast("string")).when(uid() % 5 == 1, "").otherwise(
        F.concat(F.lit("S"), uid().cast("string"))
    )


def raw_lat() -> Column:
    return F.lit(39.4) + uid() % 15 * F.lit(0.01234567)


def raw_lon() -> Column:
    return F.lit(-0.45) + uid() % 11 * F.lit(0.01234567)


def raw_air(spark, sf, wkt: bool = False):
    """Events as raw portal records of the air dataset."""
    point = (
        F.concat(
            F.lit("POINT ("),
            raw_lon().cast("decimal(12,8)").cast("string"),
            F.lit(" "),
            raw_lat().cast("decimal(12,8)").cast("string"),
            F.lit(")"),
        )
        if wkt
        else F.struct(raw_lon().alias("lon"), raw_lat().alias("lat"))
    )
    return events(spark, sf).select(
        "event_id",
        (uid() % 12).alias("objectid"),
        raw_station().alias("fiwareid"),
        raw_instant().alias("fecha_carg"),
        when_type("click").alias("no2"),
        when_type("view").alias("o3"),
        when_type("purchase").alias("so2"),
        when_type("signup").alias("co"),
        when_type("error").alias("pm10"),
        F.get_json_object("props", "$.k").cast("double").alias("pm25"),
        F.col("event_type").alias("calidad_am"),
        F.when(uid() % 6 != 0, point).alias("geo_point_2d"),
    )


STATION_SQL = """CASE WHEN user_id % 5 IN (0, 1) THEN 'obj' || CASE WHEN user_id % 12 = 0 THEN 'na'
  ELSE CAST(user_id % 12 AS VARCHAR) END ELSE 'S' || user_id END"""
WIRE_SQL = "CASE WHEN event_id % 16 <> 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END"
LAT_SQL = "CASE WHEN user_id % 6 <> 0 THEN round(39.4e0 + user_id % 15 * 0.01234567e0, 6) END"
LON_SQL = "CASE WHEN user_id % 6 <> 0 THEN round(-0.45e0 + user_id % 11 * 0.01234567e0, 6) END"
FP_SQL = (
    "sha1('{' || "
    + " || ',' || ".join(f"'\"{m}\":' || coalesce(CAST({m} AS VARCHAR), 'null')" for m in sorted(AIR.metrics))
    + " || '}')"
)
N_SQL = f"""n AS (SELECT event_id, {STATION_SQL} AS fiwareid, {WIRE_SQL} AS ts, no2, o3, so2, co, pm10, pm25,
  air_quality_summary, {LAT_SQL} AS lat, {LON_SQL} AS lon, {FP_SQL} AS fp FROM r)"""
AIR_COLS = ["fiwareid", "ts", "so2", "no2", "o3", "co", "pm10", "pm25", "air_quality_summary", "lat", "lon"]


def normalised_air(spark, sf, wkt: bool = False):
    raw = raw_air(spark, sf, wkt).withColumnRenamed("event_id", "_seq")
    return N.normalise(raw, AIR)


@query("normalise_air", f"WITH {R}, {N_SQL} SELECT event_id, {', '.join(AIR_COLS)}, fp FROM n")
def _(spark, sf):
    return normalised_air(spark, sf).select(F.col("_seq").alias("event_id"), *AIR_COLS, F.col("_fp").alias("fp"))


@query("normalise_air_wkt", f"WITH {R}, {N_SQL} SELECT event_id, fiwareid, ts, lat, lon FROM n")
def _(spark, sf):
    return normalised_air(spark, sf, wkt=True).select(F.col("_seq").alias("event_id"), "fiwareid", "ts", "lat", "lon")


@query(
    "normalise_weather",
    f"""WITH {R} SELECT event_id, {STATION_SQL} AS fiwareid, {WIRE_SQL} AS ts, wind_dir_deg, wind_speed_ms,
      temperature_c, humidity_pct, pressure_hpa, precip_mm FROM r""",
)
def _(spark, sf):
    raw = events(spark, sf).select(
        eid().alias("_event_id"),
        (uid() % 12).alias("objectid"),
        raw_station().alias("fiwareid"),
        raw_instant().alias("fecha_carg"),
        (eid() * 37 % 360).cast("int").alias("viento_dir"),
        when_type("click").alias("viento_vel"),
        when_type("view").alias("temperatur"),
        when_type("purchase").alias("humedad_re"),
        when_type("signup").alias("presion_ba"),
        when_type("error").alias("precipitac"),
    )
    return N.normalise(raw, WEATHER).select(
        F.col("_event_id").alias("event_id"), "fiwareid", "ts", *WEATHER.metrics
    )


@query(
    "project_available",
    "SELECT props, user_id, value, ts FROM events",
)
def _(spark, sf):
    ev = events(spark, sf)
    ts_col = N.choose_ts_column(ev, "fecha_carg", typed=True)
    return N.project_available(ev, ["props", "absent", "user_id", "value"], ts_col)


@query(
    "extract_lat_lon",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN round(value, 6) WHEN 1 THEN round(value, 6) END AS lat,
      CASE event_id % 3 WHEN 0 THEN round(-value / 2, 6) WHEN 1 THEN round(-value / 2, 6) END AS lon FROM events""",
)
def _(spark, sf):
    value, half = F.col("value").cast("string"), (-F.col("value") / 2).cast("string")
    text = (
        F.when(eid() % 3 == 0, F.concat(F.lit("POINT ("), half, F.lit(" "), value, F.lit(")")))
        .when(eid() % 3 == 1, F.concat(F.lit("POINT("), half, F.lit("  "), value, F.lit(" ) tail")))
        .otherwise(F.concat(F.lit(" point ("), half, F.lit(" "), value, F.lit(")")))
    )
    lat, lon = extract_lat_lon(text, "wkt")
    return events(spark, sf).select("event_id", lat.alias("lat"), lon.alias("lon"))


@query(
    "parse_floats",
    """SELECT event_id, CASE event_id % 10 WHEN 2 THEN value WHEN 3 THEN value WHEN 7 THEN 1000.0e0
      WHEN 9 THEN round(value * 10, 6) END AS parsed, event_id % 10 = 6 AS is_nan FROM events""",
)
def _(spark, sf):
    text = F.col("value").cast("string")
    spelled = (
        F.when(eid() % 10 == 0, "")
        .when(eid() % 10 == 1, "null")
        .when(eid() % 10 == 2, text)
        .when(eid() % 10 == 3, F.concat(F.lit(" "), text, F.lit("  ")))
        .when(eid() % 10 == 4, F.replace(text, F.lit("."), F.lit(",")))
        .when(eid() % 10 == 5, F.concat(text, F.lit("d")))
        .when(eid() % 10 == 6, "nan")
        .when(eid() % 10 == 7, "1_000")
        .when(eid() % 10 == 8, "abc")
        .otherwise(F.concat(text, F.lit("e1")))
    )
    parsed = parse_float_or_null(spelled)
    return events(spark, sf).select(
        "event_id",
        F.when(~F.isnan(parsed), F.round(parsed, 6)).alias("parsed"),
        F.coalesce(F.isnan(parsed), F.lit(False)).alias("is_nan"),
    )


@query(
    "combine_date_time",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts)
      WHEN 2 THEN date_trunc('minute', ts) END AS moment FROM events""",
)
def _(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    fecha = F.when(eid() % 5 == 3, F.concat(F.lit("x"), day)).when(eid() % 5 == 4, F.lit(None).cast("string")).otherwise(day)
    hora = (
        F.when(eid() % 5 == 0, F.date_format("ts", "HH:mm:ss"))
        .when(eid() % 5 == 1, "")
        .when(eid() % 5 == 2, F.concat(F.date_format("ts", "HH:mm"), F.lit("+05:00")))
        .otherwise("10:00:00")
    )
    return events(spark, sf).select("event_id", combine_date_time(fecha, hora).alias("moment"))


@query(
    "normalise_instants",
    f"""SELECT event_id, CASE WHEN event_id % 7 IN (4, 5, 6) THEN NULL ELSE {WIRE_SQL} END AS ts_utc FROM events""",
)
def _(spark, sf):
    odd = F.element_at(F.array(F.lit("2025"), F.lit("10:11"), F.lit("garbage")), (eid() % 7 - 3).cast("int"))
    text = F.when(eid() % 7 >= 4, odd).otherwise(raw_instant())
    return events(spark, sf).select("event_id", normalise_ts(text).alias("ts_utc"))


@query(
    "parse_range_bounds",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('day', ts) WHEN 4 THEN NULL
      ELSE date_trunc('second', ts) END AS moment FROM events""",
)
def _(spark, sf):
    text = (
        F.when(eid() % 5 == 0, F.date_format("ts", "yyyy-M-d"))
        .when(eid() % 5 == 1, iso("ts"))
        .when(eid() % 5 == 2, iso("ts", "Z"))
        .when(eid() % 5 == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy"))
    )
    return events(spark, sf).select("event_id", parse_datetime_any(text, strict=False).alias("moment"))


@query(
    "drop_incomplete",
    f"""WITH {R}, {N_SQL} SELECT event_id, fiwareid, ts FROM n WHERE ts IS NOT NULL AND fiwareid <> ''""",
)
def _(spark, sf):
    rows = L.drop_incomplete(normalised_air(spark, sf), ["ts", "fiwareid", "_fp"])
    return rows.select(F.col("_seq").alias("event_id"), "fiwareid", "ts")


@query(
    "keyed_events",
    f"""WITH {R}, {N_SQL} SELECT fiwareid || '|' || ts AS key, ts, no2, pm25, air_quality_summary, lat, lon, 11 AS fields
    FROM n WHERE ts IS NOT NULL""",
)
def _(spark, sf):
    keyed = N.to_keyed_events(normalised_air(spark, sf), AIR)
    body = spread(keyed, F.from_json("value", AIR.event_schema))
    return body.select(
        "key", "ts", "no2", "pm25", "air_quality_summary", "lat", "lon", F.size(F.json_object_keys("value")).alias("fields")
    )


@query(
    "keyed_events_round_trip",
    f"""WITH {R}, {N_SQL} SELECT fiwareid, CAST(strptime(ts, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ts, no2, o3, so2, co,
      pm10, pm25, air_quality_summary, lat, lon FROM n WHERE ts IS NOT NULL""",
)
def _(spark, sf):
    return N.from_keyed_events(N.to_keyed_events(normalised_air(spark, sf), AIR), AIR)


# -- change capture: the state is what a poll at noon of the 15th left behind

HOURLY = """h AS (SELECT event_id, 'S' || user_id AS fiwareid, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS ts,
  ts AS moment, sha1('{"value":' || coalesce(CAST(floor(value / 10) AS VARCHAR), 'null') || '}') AS fp FROM events)"""
MARK = "2024-01-15T12:00:00Z"
STATE_SQL = f"""seen AS (SELECT fiwareid, arg_max(fp, event_id) AS fp FROM h
  WHERE ts = '{MARK}' AND moment < TIMESTAMP '2024-01-15 12:30:00' GROUP BY 1)"""
EMIT_SQL = f"""emitted AS (SELECT h.* FROM h LEFT JOIN seen USING (fiwareid)
  WHERE h.ts > '{MARK}' OR (h.ts = '{MARK}' AND h.fp IS DISTINCT FROM seen.fp))"""


def change_batch(spark, sf):
    body = F.to_json(F.struct(F.floor(F.col("value") / 10).cast("double").alias("value")), {"ignoreNullFields": "false"})
    return events(spark, sf).select(
        eid().alias("_seq"),
        F.concat(F.lit("S"), uid().cast("string")).alias("fiwareid"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'Z'").alias("ts"),
        F.sha1(body).alias("_fp"),
        F.col("ts").alias("moment"),
    )


def noon_state(spark, rows):
    offset = literal_table(spark, [(MARK,)], "offset string")
    at_noon = rows.filter((F.col("ts") == MARK) & (F.col("moment") < F.lit("2024-01-15 12:30:00").cast("timestamp")))
    return offset, at_noon.groupBy("fiwareid").agg(F.max_by("_fp", "_seq").alias("_fp"))


def _changes(spark, sf):
    rows = change_batch(spark, sf)
    return emit_changes(rows.drop("moment"), *noon_state(spark, rows), AIR)


@query("emit_changes", f"WITH {HOURLY}, {STATE_SQL}, {EMIT_SQL} SELECT event_id, fiwareid, ts, fp FROM emitted")
def _(spark, sf):
    return _changes(spark, sf).emitted.select(seq_as_id(), "fiwareid", "ts", F.col("_fp").alias("fp"))


@query(
    "emit_changes_offset",
    f"WITH {HOURLY}, {STATE_SQL}, {EMIT_SQL} SELECT greatest(coalesce(max(ts), '{MARK}'), '{MARK}') AS offset_ts FROM emitted",
)
def _(spark, sf):
    return _changes(spark, sf).offset.select(F.col("offset").alias("offset_ts"))


@query(
    "emit_changes_seen",
    f"""WITH {HOURLY}, {STATE_SQL}, {EMIT_SQL}, m AS (SELECT max(ts) AS top FROM emitted)
    SELECT fiwareid, arg_max(fp, event_id) AS fp FROM emitted, m WHERE ts = top GROUP BY fiwareid""",
)
def _(spark, sf):
    return _changes(spark, sf).seen.select("fiwareid", F.col("_fp").alias("fp"))


@query(
    "emit_changes_same_tick",
    f"""WITH {HOURLY}, {STATE_SQL}, e AS (SELECT h.* FROM h LEFT JOIN seen USING (fiwareid)
      WHERE h.ts = '{MARK}' AND h.fp IS DISTINCT FROM seen.fp)
    SELECT fiwareid, arg_max(fp, o) AS fp FROM (SELECT fiwareid, fp, -1 AS o FROM seen
      UNION ALL SELECT fiwareid, fp, event_id FROM e) GROUP BY fiwareid""",
)
def _(spark, sf):
    # A poll that brings nothing newer: the remembered fingerprints are overlaid, not replaced.
    rows = change_batch(spark, sf)
    state = noon_state(spark, rows)
    changes = emit_changes(rows.filter(F.col("ts") <= MARK).drop("moment"), *state, AIR)
    return changes.seen.select("fiwareid", F.col("_fp").alias("fp"))


STATION_STATE_SQL = """seen AS (SELECT fiwareid, max(ts) AS off, arg_max(fp, (ts, event_id)) AS fp FROM h
  WHERE moment < TIMESTAMP '2024-01-15 12:30:00' GROUP BY 1),
  emitted AS (SELECT h.* FROM h LEFT JOIN seen USING (fiwareid)
  WHERE off IS NULL OR h.ts > off OR (h.ts = off AND h.fp IS DISTINCT FROM seen.fp))"""


def _station_changes(spark, sf):
    rows = change_batch(spark, sf)
    early = rows.filter(F.col("moment") < F.lit("2024-01-15 12:30:00").cast("timestamp"))
    seen = early.groupBy("fiwareid").agg(
        F.max("ts").alias("offset"), F.max_by("_fp", F.struct("ts", "_seq")).alias("_fp")
    )
    return emit_changes(rows.drop("moment"), seen.agg(F.max("offset").alias("offset")), seen, AIR, scope="station")


@query("emit_changes_per_station", f"WITH {HOURLY}, {STATION_STATE_SQL} SELECT event_id, fiwareid, ts FROM emitted")
def _(spark, sf):
    return _station_changes(spark, sf).emitted.select(seq_as_id(), "fiwareid", "ts")


@query(
    "emit_changes_per_station_seen",
    f"""WITH {HOURLY}, {STATION_STATE_SQL}, u AS (SELECT fiwareid, off AS ts, -1 AS event_id, fp FROM seen
      UNION ALL SELECT fiwareid, ts, event_id, fp FROM emitted)
    SELECT fiwareid, max(ts) AS offset_ts, arg_max(fp, (ts, event_id)) AS fp FROM u GROUP BY fiwareid""",
)
def _(spark, sf):
    return _station_changes(spark, sf).seen.select("fiwareid", F.col("offset").alias("offset_ts"), F.col("_fp").alias("fp"))


@query(
    "anti_seen",
    f"""WITH {HOURLY}, {STATE_SQL} SELECT event_id, h.fiwareid FROM h LEFT JOIN seen USING (fiwareid)
    WHERE h.fp IS DISTINCT FROM seen.fp""",
)
def _(spark, sf):
    rows = change_batch(spark, sf)
    return anti_seen(rows, noon_state(spark, rows)[1]).select(seq_as_id(), "fiwareid")


@query(
    "dedup_batch",
    f"""WITH {R} SELECT DISTINCT ON (fiwareid, hour) fiwareid, date_trunc('hour', ts) AS hour, event_id, no2, pm25,
      air_quality_summary FROM r ORDER BY fiwareid, hour, event_id DESC""",
)
def _(spark, sf):
    rows = readings(spark, sf).select(
        "fiwareid", F.date_trunc("hour", "ts").alias("hour"), "event_id", "no2", "pm25", "air_quality_summary"
    )
    return dedup_batch(rows, ["fiwareid", "hour"], "event_id")


# -- validation

BAD_SQL = """v AS (SELECT event_id, user_id, value, event_id % 8 AS kind FROM events)"""


def documents_to_check(spark, sf):
    """JSON texts, valid and broken in several ways, made from every event."""
    num = F.col("value").cast("string")
    sid = F.concat(F.lit('"S'), uid().cast("string"), F.lit('"'))
    kind = eid() % 8

    def doc(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    text = (
        F.when(kind == 0, doc('{"fiwareid":', sid, ',"ts":"2024-01-01T00:00:00Z","no2":', num, "}"))
        .when(kind == 1, doc('{"fiwareid":', sid, ',"ts":"2024-01-01T00:00:00Z","no2":"', num, '"}'))
        .when(kind == 2, doc('{"fiwareid":', sid, ',"no2":null,"extra":[1,2]}'))
        .when(kind == 3, doc('{"fiwareid":', uid().cast("string"), ',"ts":"x","lat":true}'))
        .when(kind == 4, doc("[", num, "]"))
        .when(kind == 5, doc('{"fiwareid":', sid))
        .when(kind == 6, doc('{"fiwareid":', sid, ',"ts":"y","air_quality_summary":5,"pm10":', uid().cast("string"), "}"))
        .otherwise(num)
    )
    return events(spark, sf).select("event_id", text.alias("value"))


ERRORS_SQL = """CASE kind WHEN 0 THEN [] WHEN 1 THEN ['no2: ''' || value || ''' is not of type ''number'', ''null''']
  WHEN 2 THEN ['(root): ''ts'' is a required property']
  WHEN 3 THEN ['fiwareid: ' || user_id || ' is not of type ''string''', 'lat: True is not of type ''number'', ''null''']
  WHEN 5 THEN ['(root): invalid JSON'] WHEN 6 THEN ['air_quality_summary: 5 is not of type ''string'', ''null''']
  WHEN 4 THEN ['(root): list'] ELSE ['(root): number'] END"""


@query(
    "validate_errors",
    f"""WITH {BAD_SQL}, e AS (SELECT event_id, {ERRORS_SQL} AS errors FROM v)
    SELECT event_id, len(errors) AS error_count, array_to_string(errors, '; ') AS errors FROM e""",
)
def _(spark, sf):
    # The text of a rejected list or number is left to unit tests: engines print numbers differently.
    shown = F.transform(
        "errors",
        lambda e: F.when(e.startswith("(root): ["), "(root): list")
        .when(e.rlike(r"^\(root\): [\d.]+ is not of type 'object'$"), "(root): number")
        .otherwise(e),
    )
    return Q.with_validation_errors(documents_to_check(spark, sf), AIR).select(
        "event_id",
        F.size("errors").cast("long").alias("error_count"),
        F.array_join(shown, "; ").alias("errors"),
    )


@query(
    "validate_counts",
    f"""WITH {BAD_SQL} SELECT count(*) FILTER (WHERE kind = 0) AS valid_count,
      count(*) FILTER (WHERE kind > 0) AS invalid_count,
      CAST(sum(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS BIGINT) AS error_count FROM v""",
)
def _(spark, sf):
    return Q.validate(documents_to_check(spark, sf), AIR)[2]


# -- landed pages and files made from the events

PAGE_ROWS = 100


@query(
    "record_pages",
    f"""WITH {R} SELECT event_id, no2, pm25, CASE WHEN event_id % 16 <> 3 THEN 1 ELSE 0 END AS has_ts FROM r""",
)
def _(spark, sf):
    raw = raw_air(spark, sf)
    record = F.struct(
        F.col("event_id").alias("objectid"), "fiwareid", "fecha_carg", "no2", "pm25", "calidad_am", "geo_point_2d"
    )
    # A page holds a bounded run of event numbers, as the portal's pages hold a bounded run of records.
    pages = raw.groupBy(F.floor(F.col("event_id") / PAGE_ROWS).alias("page")).agg(F.collect_list(record).alias("rows"))
    kind = F.col("page") % 4
    body = F.to_json("rows")
    text = (
        F.when(kind == 0, F.concat(F.lit('{"total_count":1,"results":'), body, F.lit("}")))
        .when(kind == 1, body)
        .when(kind == 2, F.concat(F.lit('{"features":'), body, F.lit("}")))
        .otherwise(F.concat(F.lit('{"data":5,"result":{"records":'), body, F.lit("}}")))
    )
    named = pages.select(F.concat(F.lit("page_"), "page", F.lit(".json")).alias("file"), text.alias("value"))
    records, _ = S.parse_record_pages(named, AIR.raw_schema)
    return records.select(
        F.col("objectid").alias("event_id"), "no2", "pm25", F.col("fecha_carg").isNotNull().cast("int").alias("has_ts")
    )


@query("json_lines", f"WITH {R} SELECT event_id, no2, pm25 FROM r")
def _(spark, sf):
    folder = work_dir(spark, "lines")
    raw_air(spark, sf).withColumn("objectid", eid()).drop("event_id").write.json(folder)
    rows = S.read_json_or_ndjson(spark, folder, AIR.raw_schema)
    return rows.select(F.col("objectid").alias("event_id"), "no2", "pm25")


def land_history(spark, sf) -> str:
    folder = work_dir(spark, "history")
    named_history(spark, sf).select(
        "estacion",
        F.when(eid() % 9 == 4, F.lit("no date")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("fecha"),
        F.date_format("ts", "HH:mm:ss").alias("hora"),
        when_type("click").alias("no2"),
        when_type("view").alias("o3"),
        F.when(eid() % 5 == 0, F.lit("null")).otherwise(F.col("value").cast("string")).alias("pm2_5"),
        (eid() * 37 % 360).alias("direccion_del_viento"),
        F.when(eid() % 4 != 0, F.col("value").cast("string")).otherwise("n/a").alias("temperatura"),
        when_type("error").alias("precipitacion"),
    ).write.option("header", True).csv(folder)
    return folder


HISTORY_SQL = f"""h AS (SELECT *, {NAME_SQL} AS estacion, CASE WHEN event_id % 9 <> 4 THEN date_trunc('second', ts) END AS moment
  FROM events)"""


@query(
    "history_air",
    f"""WITH {names_sql("air")}, {HISTORY_SQL} SELECT fiwareid, moment AS ts, CASE WHEN event_type = 'click' THEN value END AS no2,
      CASE WHEN event_type = 'view' THEN value END AS o3, CASE WHEN event_id % 5 <> 0 THEN value END AS pm25, lat, lon
    FROM h JOIN n USING (estacion) WHERE moment IS NOT NULL""",
)
def _(spark, sf):
    history = S.read_history_csv(spark, land_history(spark, sf))
    return backfill(history, historical_names(spark, "air"), AIR).rows.select(
        "fiwareid", "ts", "no2", "o3", "pm25", "lat", "lon"
    )


@query(
    "history_weather",
    f"""WITH {names_sql("weather")}, {HISTORY_SQL} SELECT fiwareid, moment AS ts, CAST(event_id * 37 % 360 AS DOUBLE) AS wind_dir_deg,
      value AS temperature_c, CASE WHEN event_type = 'error' THEN value END AS precip_mm, lat, lon
    FROM h JOIN n USING (estacion) WHERE moment IS NOT NULL AND event_id % 4 <> 0""",
)
def _(spark, sf):
    history = S.read_history_csv(spark, land_history(spark, sf))
    return backfill(history, historical_names(spark, "weather"), WEATHER).rows.select(
        "fiwareid", "ts", "wind_dir_deg", "temperature_c", "precip_mm", "lat", "lon"
    )


@query(
    "history_load_report",
    f"""WITH {names_sql("weather")}, {HISTORY_SQL},
    j AS (SELECT fiwareid IS NOT NULL AND moment IS NOT NULL AND event_id % 4 <> 0 AS ok FROM h LEFT JOIN n USING (estacion))
    SELECT count(*) FILTER (WHERE ok) AS loaded, count(*) FILTER (WHERE NOT ok) AS skipped FROM j""",
)
def _(spark, sf):
    history = S.read_history_csv(spark, land_history(spark, sf))
    return backfill(history, historical_names(spark, "weather"), WEATHER).report


@query(
    "poll_to_events",
    f"""WITH {R}, {N_SQL} SELECT fiwareid || '|' || ts AS key, no2, pm25 FROM n WHERE ts > '{MARK}'""",
)
def _(spark, sf):
    raw = raw_air(spark, sf).withColumnRenamed("event_id", "_seq")
    offset = literal_table(spark, [(MARK,)], "offset string")
    # No station was seen exactly at the mark, and no reading falls on it.
    seen = literal_table(spark, [], "fiwareid string, _fp string")
    keyed, _ = poll(raw, None, offset, seen, AIR)
    return spread(keyed, F.from_json("value", AIR.event_schema)).select("key", "no2", "pm25")


@query(
    "replay_events",
    f"""WITH {R} SELECT fiwareid || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS key, no2, pm25 FROM r
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' ORDER BY ts""",
)
def _(spark, sf):
    keyed = replay(readings(spark, sf), AIR, "2024-01-10T00:00:00", "2024-01-20T00:00:00")
    return spread(keyed, F.from_json("value", AIR.event_schema)).select("key", "no2", "pm25")


@query(
    "replay_dry_run",
    "SELECT count(*) AS events FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'",
)
def _(spark, sf):
    return replay(readings(spark, sf), AIR, "2024-01-10T00:00:00", "2024-01-20T00:00:00", dry_run=True)


@query(
    "replay_resumed",
    f"""WITH {R} SELECT fiwareid || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS key, CAST(floor(epoch(ts - TIMESTAMP '2024-01-10') / 172800) AS INT) AS slice
    FROM r WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
)
def _(spark, sf):
    folder, interrupted = work_dir(spark, "replay"), []

    def send(keyed, number):
        keyed.write.mode("overwrite").json(f"{folder}/topic/slice={number}")
        if number == 2 and not interrupted:
            interrupted.append(number)
            raise ConnectionError("the link is gone")

    bounds = datetime(2024, 1, 10), datetime(2024, 1, 20)
    for _ in range(2):  # the first call is cut off after sending a slice, before it is noted
        with contextlib.suppress(ConnectionError):
            replay_slices(readings(spark, sf), AIR, *bounds, send, f"{folder}/checkpoint.json", "2 days", per_second=1e6)
    return spark.read.json(f"{folder}/topic").select("key", F.col("slice").cast("int").alias("slice"))


@query("json_lines_cut", f"WITH {R} SELECT event_id, no2, pm25 FROM r WHERE event_id % 211 <> 1")
def _(spark, sf):
    folder = work_dir(spark, "lines")
    whole = F.to_json(F.struct("*"))
    rows = raw_air(spark, sf).withColumn("objectid", eid()).drop("event_id")
    # Every file begins with a line that is cut off; there are as many files as the rows need.
    files = max(3, -(-rows.count() // FILE_ROWS))
    cut = F.when(F.col("objectid") % 211 == 1, F.substring(whole, 1, 25)).otherwise(whole)
    lines = rows.select("objectid", cut.alias("value")).repartition(files, "objectid", "value").sortWithinPartitions(F.col("objectid") % 211 != 1)
    lines.select("value").write.text(folder)
    found = S.read_json_or_ndjson(spark, folder, AIR.raw_schema, strict=False)
    return found.select(F.col("objectid").alias("event_id"), "no2", "pm25")


@query("export_dataset", "SELECT 'readings' AS dataset_id, count(*) AS total_records FROM events")
def _(spark, sf):
    folder = work_dir(spark, "export")
    export_dataset(readings(spark, sf), folder, "readings")
    meta = spark.read.schema("dataset_id string, total_records long").json(f"{folder}/readings/metadata")
    return meta.select("dataset_id", "total_records")


PAYLOAD_M = haversine_sql(f"{HOME_POINT[0]}e0", f"{HOME_POINT[1]}e0", "lat", "lon")


@query(
    "topk_payload",
    f"""WITH {R}, s AS (SELECT DISTINCT fiwareid, lat, lon FROM r WHERE contains(lower(fiwareid), 's1')),
    k AS (SELECT fiwareid, {PAYLOAD_M} AS m FROM s ORDER BY m, fiwareid LIMIT 10)
    SELECT 'stations' AS dataset_id, 'S1' AS filter_pattern, CAST(count(*) AS INTEGER) AS count,
      string_agg(fiwareid, ',' ORDER BY m, fiwareid) AS features FROM k""",
)
def _(spark, sf):
    stations = L.contains_ci(readings(spark, sf).select("fiwareid", "lat", "lon").distinct(), "fiwareid", "S1")
    payload = topk_payload(k_nearest(stations, *HOME_POINT, 10), "stations", *HOME_POINT, "fiwareid", "S1")
    return payload.select("dataset_id", "filter_pattern", "count", F.array_join("features.fiwareid", ",").alias("features"))


@query(
    "quarantined_requeue",
    f"""WITH {BAD_SQL} SELECT CAST(event_id AS VARCHAR) AS key FROM v WHERE kind > 0""",
)
def _(spark, sf):
    folder = work_dir(spark, "quarantine")
    docs = documents_to_check(spark, sf)
    _, rejected, _ = Q.validate(docs, AIR)
    Q.quarantine(rejected.select(eid().cast("string").alias("key"), "value"), folder, 0)
    waiting, _ = Q.requeue(spark, folder)
    return waiting.select("key")


@query(
    "dead_letters",
    f"""WITH {BAD_SQL} SELECT 'S' || user_id AS key, value FROM v WHERE kind NOT IN (0, 1)""",
)
def _(spark, sf):
    folder = work_dir(spark, "dead")
    kind = eid() % 8
    line = F.to_json(
        F.struct(
            F.concat(F.lit("S"), uid().cast("string")).alias("key"),
            F.col("value").cast("string").alias("value"),
            F.unix_seconds("ts").cast("double").alias("ts"),
        )
    )
    # Every eighth line is blank and another eighth is cut short.
    events(spark, sf).select(
        F.when(kind == 0, "  ").when(kind == 1, F.substring(line, 1, 9)).otherwise(line).alias("value")
    ).write.text(folder)
    rows, _ = Q.read_dead_letters(spark, folder)
    return rows.select("key", F.col("value").cast("double").alias("value"))


@query(
    "load_report",
    f"""WITH {R} SELECT event_type, count(temperature_c) AS loaded, count(*) - count(temperature_c) AS skipped FROM r
    GROUP BY event_type""",
)
def _(spark, sf):
    return Q.load_report(readings(spark, sf), F.col("temperature_c").isNotNull(), ["event_type"])
