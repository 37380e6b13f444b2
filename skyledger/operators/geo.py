"""Places near a point."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.geo import bounding_box, ellipsoid_m, haversine_m, valid_lat_lon
from skyledger.functions.once import spread

MODELS = {"sphere": haversine_m, "spheroid": ellipsoid_m}


def stations_within(
    df: DataFrame, lat: float, lon: float, metres: float, model: str = "spheroid", cols: Sequence[str] = ("fiwareid",)
) -> DataFrame:
    """Distinct stations within ``metres``, edge included.

    A range predicate prunes at the scan and distances are taken on distinct places, not on every reading.
    """
    near = df.filter(bounding_box("lat", "lon", lat, lon, metres))
    places = near.select(*dict.fromkeys([*cols, "lat", "lon"])).distinct()
    # Computed behind a barrier: pushed below the distinct, the filter would measure every reading.
    measured = spread(places, F.struct(MODELS[model]("lat", "lon", lat, lon).alias("_metres")))
    return measured.filter(F.col("_metres") <= F.lit(float(metres))).select(*cols).distinct().orderBy(*cols)


def k_nearest(
    df: DataFrame, lat: float, lon: float, k: int = 10, tie_break: Sequence[str] = ("fiwareid",)
) -> DataFrame:
    """The ``k`` rows nearest to a point, with ``distance_meters``; a top-k, not a sort of the whole table."""
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    if not (-90 <= lat <= 90 and -180 <= lon <= 180):
        raise ValueError(f"reference point out of bounds: {lat}, {lon}")
    measured = df.filter(valid_lat_lon("lat", "lon")).withColumn("distance_meters", haversine_m(lat, lon, "lat", "lon"))
    return measured.orderBy("distance_meters", *tie_break).limit(k)
