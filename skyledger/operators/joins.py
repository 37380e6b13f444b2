"""Station lookups. Small sides are left to Spark's own size-checked broadcast."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.geo import haversine_m, valid_lat_lon
from skyledger.session import written

# Metres per degree of latitude, rounded down so that grid cells are never too small.
METRES_PER_DEGREE = 110000.0
# About the sixth decimal of a coordinate, to which places are rounded: a cell that small holds one place.
FINEST_CELL_M = 0.1
SPLIT_BITS = 4


def map_station_ids(
    history: DataFrame, names: DataFrame, station: str = "estacion", key: str = "fiwareid"
) -> tuple[DataFrame, DataFrame]:
    """Rows whose historical name is known, with id and place; and the rows without a match."""
    dim = names.select(F.col("historical_name").alias(station), key, "lat", "lon")
    return history.join(dim, station), history.join(dim, station, "left_anti")


def anti_seen(batch: DataFrame, seen: DataFrame, key: str = "fiwareid", fp: str = "_fp") -> DataFrame:
    """Rows whose fingerprint differs from the one remembered for the station, or that has none."""
    known = seen.select(key, F.col(fp).alias("_seen_fp"))
    return batch.join(known, key, "left").filter(~F.col(fp).eqNullSafe(F.col("_seen_fp"))).drop("_seen_fp")


def consolidate_station_ids(
    df: DataFrame, id_map: DataFrame, drop_ids: Sequence[str], key: str = "fiwareid"
) -> DataFrame:
    """Retired ids rewritten and dropped ids removed; feed the result to an upsert to settle collisions."""
    renamed = df.filter(~F.col(key).isin(list(drop_ids))) if drop_ids else df
    mapping = id_map.select(F.col("old_id").alias(key), "new_id")
    return renamed.join(mapping, key, "left").withColumn(key, F.coalesce("new_id", key)).drop("new_id")


def station_coord_match(
    left: DataFrame,
    right: DataFrame,
    max_m: float,
    left_id: str = "fiwareid",
    right_id: str = "historical_id",
) -> DataFrame:
    """The nearest right station within ``max_m`` of each left one, ties to the smaller id.

    Stations at one place are matched once per place, and places are narrowed down by cells: a left place
    starts from the nine cells of ``max_m`` around it and keeps those that can still hold its nearest
    partner; each round splits the kept ones sixteenfold per side. So a crowded cell is never paired with all
    places in it, and the result is still exact. Places of both sides, with the cells of the right ones, are written to
    scratch tables once; rounds read those.
    """
    rounds = max(0, math.ceil(math.log(max(max_m, FINEST_CELL_M) / FINEST_CELL_M, 2**SPLIT_BITS)))
    finest = SPLIT_BITS * rounds
    lat_step = max_m / METRES_PER_DEGREE
    places = left.filter(valid_lat_lon("lat", "lon")).select("lat", "lon").distinct()
    targets = (
        right.filter(valid_lat_lon("lat", "lon"))
        .groupBy(F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))
        .agg(F.min(right_id).alias(right_id))
        .withColumn("_y", F.floor(F.col("r_lat") / F.lit(lat_step / 2**finest)).cast("long"))
        .withColumn("_row", F.shiftright("_y", finest))
        .withColumn("r_lon", F.explode(_turns(F.col("r_lon"), _lon_step(F.col("_row"), max_m))))
        .withColumn("_x", F.floor(F.col("r_lon") / _lon_step(F.col("_row"), max_m) * F.lit(2**finest)).cast("long"))
    )
    places, targets = written(places, "places"), written(targets, "cells")
    here = F.floor(F.col("lat") / F.lit(lat_step)).cast("long")
    kept = (
        places.withColumn("_row", F.explode(_steps(here)))
        .withColumn("_y", F.col("_row"))
        .withColumn("_x", F.explode(_steps(F.floor(F.col("lon") / _lon_step(F.col("_row"), max_m)).cast("long"))))
        .join(_cells(targets, finest), ["_row", "_y", "_x"])
    )
    mine = Window.partitionBy("lat", "lon")
    for level in range(rounds + 1):
        if level:
            children = _cells(targets, finest - SPLIT_BITS * level).select(
                "_row",
                F.shiftright("_y", SPLIT_BITS).alias("_y"),
                F.shiftright("_x", SPLIT_BITS).alias("_x"),
                F.col("_y").alias("_child_y"),
                F.col("_x").alias("_child_x"),
            )
            kept = kept.join(children, ["_row", "_y", "_x"]).select(
                "lat", "lon", "_row", F.col("_child_y").alias("_y"), F.col("_child_x").alias("_x")
            )
        near, far = _cell_distances(max_m, level)
        kept = (
            kept.withColumns({"_near": near, "_far": far})
            .withColumn("_reach", F.least(F.min("_far").over(mine), F.lit(max_m * 1.05 + 0.1)))
            .filter(F.col("_near") <= F.col("_reach"))
            .select("lat", "lon", "_row", "_y", "_x")
        )
    nearest = (
        kept.join(targets, ["_row", "_y", "_x"])
        .withColumn("distance_m", haversine_m("lat", "lon", "r_lat", "r_lon"))
        .filter(F.col("distance_m") <= F.lit(float(max_m)))
        .groupBy("lat", "lon")
        .agg(F.min(F.struct("distance_m", right_id)).alias("_best"))
        .select("lat", "lon", F.col(f"_best.{right_id}").alias(right_id), F.col("_best.distance_m").alias("distance_m"))
    )
    return left.join(nearest, ["lat", "lon"]).select(left_id, right_id, "distance_m")


def _cells(targets: DataFrame, shift: int) -> DataFrame:
    """Occupied cells, ``shift`` bits coarser than the finest."""
    return targets.select(
        "_row", F.shiftright("_y", shift).alias("_y"), F.shiftright("_x", shift).alias("_x")
    ).distinct()


def _cell_distances(max_m: float, level: int) -> tuple[Column, Column]:
    """Metres from a place to the nearest and farthest point of a cell, with room for the earth's curvature."""
    high = F.lit(max_m / METRES_PER_DEGREE / 2 ** (SPLIT_BITS * level))
    wide = _lon_step(F.col("_row"), max_m) / F.lit(2 ** (SPLIT_BITS * level))
    lat, lon = F.col("lat"), F.col("lon")
    south, west = F.col("_y") * high, F.col("_x") * wide
    north, east = south + high, west + wide
    near = haversine_m(lat, lon, F.least(F.greatest(lat, south), north), F.least(F.greatest(lon, west), east))
    far_lat = F.when(lat - south > north - lat, south).otherwise(north)
    far_lon = F.when(lon - west > east - lon, west).otherwise(east)
    return near * 0.98 - 0.01, haversine_m(lat, lon, far_lat, far_lon) * 1.02 + 0.01


def _turns(lon: Column, step: Column) -> Column:
    """A longitude and, near the date line, the same one a turn further, so that both sides meet."""
    return F.array_compact(
        F.array(lon, F.when(lon + 360 < 180 + 3 * step, lon + 360), F.when(lon - 360 > -180 - 3 * step, lon - 360))
    )


def _steps(centre: Column) -> Column:
    return F.array(centre - 1, centre, centre + 1)


def _lon_step(row: Column, max_m: float) -> Column:
    """Cell width in degrees of longitude for a row of cells, wide enough for a partner one row nearer the pole."""
    lat_step = max_m / METRES_PER_DEGREE
    edge = F.greatest(F.abs((row - 1) * F.lit(lat_step)), F.abs((row + 2) * F.lit(lat_step)))
    return F.lit(lat_step) / F.greatest(F.cos(F.radians(F.least(edge, F.lit(90.0)))), F.lit(1e-3))
