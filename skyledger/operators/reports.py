"""Station reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.geo import generated_geo
from skyledger.functions.numeric import format_value, sea_level_pressure
from skyledger.operators.order import sort_nulls_last
from skyledger.session import literal_table

# Report label, unit and decimals per raw field.
WEATHER_CATALOGUE = [
    ("viento_dir", "Wind Dir", "°", 0),
    ("viento_vel", "Wind Spd", "m/s", 1),
    ("temperatur", "Temp", "°C", 1),
    ("humedad_re", "Humidity", "%", 0),
    ("presion_ba", "Pressure", "hPa", 1),
    ("precipitac", "Rain", "mm", 1),
]
AIR_CATALOGUE = [(name, name, "µg/m³", 1) for name in ("so2", "no2", "o3", "co", "pm10", "pm25")]
SHORT_NAMES = [("ESTACIÓN", "EST."), ("JARDINES DE ", "JD ")]


def catalogue(spark: SparkSession, rows: Sequence[tuple[str, str, str, int]]) -> DataFrame:
    return literal_table(spark, rows, "metric string, label string, unit string, decimals int")


def station_report(df: DataFrame, metrics: Sequence[str], cat: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per station and metric with label, unit and rendered value; unlisted metrics keep their name."""
    long = df.unpivot(list(ids), list(metrics), "metric", "value")
    described = long.join(cat, "metric", "left")
    unit, places = F.coalesce("unit", F.lit("")), F.coalesce("decimals", F.lit(1))
    return described.select(
        *ids,
        "metric",
        "value",
        F.coalesce("label", "metric").alias("label"),
        unit.alias("unit"),
        format_value("value", places, unit).alias("shown"),
    )


def station_list(df: DataFrame, columns: Sequence[str] = ("objectid", "fiwareid", "nombre", "direccion")) -> DataFrame:
    """Stations in object-id order, unknown ids last, with a place only where both parts are known."""
    rows = df.select(*columns, generated_geo("lat", "lon").alias("place"))
    return sort_nulls_last(rows, columns[0], columns[1:])


def short_name(name):
    """Station name cut down for narrow tables."""
    col = F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit(""))
    for long, short in SHORT_NAMES:
        col = F.replace(col, F.lit(long), F.lit(short))
    return col


def with_sea_level_pressure(
    df: DataFrame, elevations: DataFrame, key: str = "fiwareid", temperature: str | None = None
) -> DataFrame:
    """Adds ``pressure_slp_hpa``; stations of unknown height get NULL and keep their station pressure."""
    joined = df.join(elevations.select(key, "elevation_m"), key, "left")
    return joined.withColumn("pressure_slp_hpa", sea_level_pressure("pressure_hpa", "elevation_m", temperature))
