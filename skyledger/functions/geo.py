"""Points and distances on the earth."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius, and the WGS84 semi-major axis and flattening.
EARTH_RADIUS_M = 6371000.0
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563

# WKT point text, and the two reference points and radii the dashboards use.
WKT_POINT = r"^POINT\s*\(\s*([-\d.]+)\s+([-\d.]+)\s*\)"
HOME_POINT = (39.493804279841314, -0.4026670632153834)
CENTRE_POINT = (39.470, -0.376)


def _num(value: Column | str | float) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle metres on the mean sphere."""
    p1, p2 = F.radians(_num(lat1)), F.radians(_num(lat2))
    half_dp, half_dl = (p2 - p1) / 2, F.radians(_num(lon2) - _num(lon1)) / 2
    a = F.sin(half_dp) * F.sin(half_dp) + F.cos(p1) * F.cos(p2) * F.sin(half_dl) * F.sin(half_dl)
    # Rounding can lift the term past one for opposite points; NULL in, NULL out.
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(a), F.sqrt(F.abs(1 - a)))


def ellipsoid_m(lat1, lon1, lat2, lon2) -> Column:
    """WGS84 metres with Lambert's correction of the central angle between reduced latitudes."""
    b1 = F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(_num(lat1))))
    b2 = F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(_num(lat2))))
    half_db, half_dl = (b2 - b1) / 2, F.radians(_num(lon2) - _num(lon1)) / 2
    h = F.sin(half_db) * F.sin(half_db) + F.cos(b1) * F.cos(b2) * F.sin(half_dl) * F.sin(half_dl)
    angle = 2 * F.atan2(F.sqrt(h), F.sqrt(F.abs(1 - h)))
    mid = (b1 + b2) / 2
    x = F.try_divide(
        (angle - F.sin(angle)) * F.pow(F.sin(mid) * F.cos(half_db), F.lit(2.0)), F.pow(F.cos(angle / 2), F.lit(2.0))
    )
    y = F.try_divide(
        (angle + F.sin(angle)) * F.pow(F.cos(mid) * F.sin(half_db), F.lit(2.0)), F.pow(F.sin(angle / 2), F.lit(2.0))
    )
    # The second quotient is 0/0 for equal points, where it has no part in the result.
    return F.lit(WGS84_A) * (angle - F.lit(WGS84_F / 2) * (F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0))))


def valid_lat_lon(lat: Column | str, lon: Column | str) -> Column:
    """True for a point on the globe; false, never NULL, when a part is missing."""
    inside = _num(lat).between(-90.0, 90.0) & _num(lon).between(-180.0, 180.0)
    return F.coalesce(inside, F.lit(False))


def generated_geo(lat: Column | str, lon: Column | str) -> Column:
    """A point only when both parts are known."""
    lat, lon = _num(lat), _num(lon)
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def extract_lat_lon(geo: Column | str, kind: str = "struct") -> tuple[Column, Column]:
    """Latitude and longitude to six decimals from a ``struct<lat,lon>`` or ``wkt`` column, else NULLs."""
    geo = F.col(geo) if isinstance(geo, str) else geo
    if kind == "struct":
        lat, lon = geo["lat"].cast("double"), geo["lon"].cast("double")
    elif kind == "wkt":
        lon = F.regexp_extract(geo, WKT_POINT, 1).try_cast("double")
        lat = F.regexp_extract(geo, WKT_POINT, 2).try_cast("double")
    else:
        raise ValueError(f"unknown geometry kind {kind!r}")
    known = lat.isNotNull() & lon.isNotNull()
    return F.when(known, F.round(lat, 6)), F.when(known, F.round(lon, 6))


def point_or_geometry(point: Column | str, geometry: Column | str) -> tuple[Column, Column]:
    """Coordinates of ``point``; GeoJSON ``geometry.coordinates`` only where there is no point object."""
    point = F.col(point) if isinstance(point, str) else point
    geometry = F.col(geometry) if isinstance(geometry, str) else geometry
    pair = geometry["coordinates"]
    lat = F.when(point.isNotNull(), point["lat"]).otherwise(F.try_element_at(pair, F.lit(2)))
    lon = F.when(point.isNotNull(), point["lon"]).otherwise(F.try_element_at(pair, F.lit(1)))
    ok = valid_lat_lon(lat, lon)
    return F.when(ok, lat), F.when(ok, lon)


def bounding_box(lat: Column | str, lon: Column | str, lat0: float, lon0: float, metres: float) -> Column:
    """A plain range predicate that holds for every point within ``metres``; file statistics can use it."""
    lat, lon = _num(lat), _num(lon)
    reach = metres / 110000.0
    south, north = lat0 - reach, lat0 + reach
    box = lat.between(south, north)
    if max(abs(south), abs(north)) >= 89.0:
        return box
    side = metres / (110000.0 * math.cos(math.radians(max(abs(south), abs(north)))))
    if side >= 180.0:
        return box
    west, east = lon0 - side, lon0 + side
    if west < -180.0:
        return box & ((lon <= east) | (lon >= west + 360.0))
    if east > 180.0:
        return box & ((lon >= west) | (lon <= east - 360.0))
    return box & lon.between(west, east)
