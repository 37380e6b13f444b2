"""The registry itself, and the adapter from the ``events`` table to readings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a query. Its instants leave as zone-free UTC timestamps, like the SQL engine's."""

    def keep(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return zone_free(build(spark, sf_dir))

        QUERIES[name] = Query(name, run, sql)
        return build

    return keep


def zone_free(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, cols: Sequence[str] | None = None, places: int = 6) -> DataFrame:
    """Doubles cut to a fixed number of places, so that summation order does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    chosen = set(doubles if cols is None else cols)
    return df.select(*[F.round(c, places).alias(c) if c in chosen else F.col(c) for c in df.columns])


EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with a fixed schema; instants are read as UTC, so bounds on them reach the scan."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def landed_parts(spark: SparkSession, sf_dir: str, folder: str, parts: int = 5, shape=None) -> Iterator[int]:
    """Append the events to a folder in parts of whole days, oldest first; a stream run after each part has as many
    micro-batches. ``shape`` turns events into what is written."""
    rows = events(spark, sf_dir)
    first, last = rows.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    step = -(-((last - first).days + 1) // parts)
    for n in range(parts):
        low, high = first + timedelta(days=n * step), first + timedelta(days=(n + 1) * step)
        part = rows.filter((F.col("ts") >= F.lit(low).cast("timestamp")) & (F.col("ts") < F.lit(high).cast("timestamp")))
        if shape is None:
            part.write.mode("append").parquet(folder)
        else:
            shape(part).write.mode("append").json(folder)
        yield n


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).parquet(folder)


def when_type(name: str) -> Column:
    return F.when(F.col("event_type") == name, F.col("value"))


def as_readings(ev: DataFrame) -> DataFrame:
    """Events as readings of both datasets: one station per user, one sparse metric per event type."""
    return ev.select(
        "event_id",
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("fiwareid"),
        "ts",
        when_type("click").alias("no2"),
        when_type("view").alias("o3"),
        when_type("purchase").alias("so2"),
        when_type("signup").alias("co"),
        when_type("error").alias("pm10"),
        F.get_json_object("props", "$.k").cast("double").alias("pm25"),
        F.col("event_type").alias("air_quality_summary"),
        (F.col("event_id") * 37 % 360).cast("double").alias("wind_dir_deg"),
        when_type("click").alias("wind_speed_ms"),
        when_type("view").alias("temperature_c"),
        when_type("purchase").alias("humidity_pct"),
        when_type("signup").alias("pressure_hpa"),
        when_type("error").alias("precip_mm"),
        (F.lit(39.4) + F.col("user_id") % 15 * F.lit(0.01)).alias("lat"),
        (F.lit(-0.45) + F.col("user_id") % 11 * F.lit(0.01)).alias("lon"),
        "user_id",
        "event_type",
        "value",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(events(spark, sf_dir))


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest instant, standing in for now."""
    return events(spark, sf_dir).agg(F.max("ts").alias("as_of"))


# The same adapter as a common table expression.
R = """r AS (
  SELECT event_id, 'S' || user_id AS fiwareid, ts,
    CASE WHEN event_type = 'click' THEN value END AS no2,
    CASE WHEN event_type = 'view' THEN value END AS o3,
    CASE WHEN event_type = 'purchase' THEN value END AS so2,
    CASE WHEN event_type = 'signup' THEN value END AS co,
    CASE WHEN event_type = 'error' THEN value END AS pm10,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS pm25,
    event_type AS air_quality_summary,
    CAST(event_id * 37 % 360 AS DOUBLE) AS wind_dir_deg,
    CASE WHEN event_type = 'click' THEN value END AS wind_speed_ms,
    CASE WHEN event_type = 'view' THEN value END AS temperature_c,
    CASE WHEN event_type = 'purchase' THEN value END AS humidity_pct,
    CASE WHEN event_type = 'signup' THEN value END AS pressure_hpa,
    CASE WHEN event_type = 'error' THEN value END AS precip_mm,
    39.4e0 + user_id % 15 * 1e-2 AS lat,
    -0.45e0 + user_id % 11 * 1e-2 AS lon,
    user_id, event_type, value
  FROM events)"""
NOW_SQL = "(SELECT max(ts) FROM events)"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371000e0 * atan2(sqrt({a}), sqrt(1 - {a})))"


def ellipsoid_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Lambert's distance; the points must differ."""
    f = "(1e0 / 298.257223563e0)"
    b1, b2 = f"atan((1 - {f}) * tan(radians({lat1})))", f"atan((1 - {f}) * tan(radians({lat2})))"
    h = (
        f"(pow(sin(({b2} - {b1}) / 2), 2) + cos({b1}) * cos({b2})"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    s = f"(2 * atan2(sqrt({h}), sqrt(1 - {h})))"
    x = f"(({s} - sin({s})) * pow(sin(({b1} + {b2}) / 2) * cos(({b2} - {b1}) / 2), 2) / pow(cos({s} / 2), 2))"
    y = f"(({s} + sin({s})) * pow(cos(({b1} + {b2}) / 2) * sin(({b2} - {b1}) / 2), 2) / pow(sin({s} / 2), 2))"
    return f"(6378137e0 * ({s} - {f} / 2 * ({x} + {y})))"
