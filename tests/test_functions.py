import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.functions import geo, numeric, time
from skyledger.functions.fingerprint import value_fingerprint
from skyledger.spec import AIR


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def over(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-10-18T19:00:00.500+02:00", "2025-10-18T17:00:00Z"),
        ("2025-10-18T17:00:00.123456Z", "2025-10-18T17:00:00Z"),
        ("2025-10-18T17:00:00+00:00", "2025-10-18T17:00:00Z"),
        ("2025-10-18T17:00:00", "2025-10-18T17:00:00Z"),
        ("2025-10-18 17:00", "2025-10-18T17:00:00Z"),
        ("2025-10-18T17:00Z", "2025-10-18T17:00:00Z"),
        ("2025-10-18T19:00+0200", "2025-10-18T17:00:00Z"),
        ("2025-10-18T17:00:00.123456789Z", "2025-10-18T17:00:00Z"),
        ("2025-10-18+02:00", None),
        ("2025-10-18", "2025-10-18T00:00:00Z"),
        ("2025", None),
        ("10:11", None),
        ("garbage", None),
        ("2025-13-18T17:00:00Z", None),
        ("", None),
        (None, None),
    ],
)
def test_normalise_ts(spark, text, expected):
    assert one(spark, time.normalise_ts(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "day, hour, expected",
    [
        ("2021-01-01", "10:00", "2021-01-01T10:00:00Z"),
        ("2021-01-01", "10:00:30", "2021-01-01T10:00:30Z"),
        ("2021-01-01", "10:00:30+05:00", "2021-01-01T10:00:30Z"),
        ("2021-01-01", "", "2021-01-01T00:00:00Z"),
        ("2021-01-01", None, "2021-01-01T00:00:00Z"),
        ("2021-01-01T07:30", None, "2021-01-01T07:30:00Z"),
        ("2021-02-30", "10:00", None),
        ("x", "10:00", None),
        ("", "10:00", None),
        (None, "10:00", None),
    ],
)
def test_combine_date_time(spark, day, hour, expected):
    made = time.combine_date_time(F.lit(day).cast("string"), F.lit(hour).cast("string"))
    assert one(spark, time.format_ts(made)) == expected


def test_parse_float_or_null(spark):
    texts = ["", "null", "1.5", " 1.5 ", "1,5", "1d", "nan", "1_000", "-2e3", ".5", "5.", "inf", "  ", "1__0", None]
    got = over(spark, texts, "string", numeric.parse_float_or_null)
    assert math.isnan(got.pop(6))
    assert got == [None, None, 1.5, 1.5, None, None, 1000.0, -2000.0, 0.5, 5.0, math.inf, None, None, None]


def test_parse_datetime_any(spark):
    texts = ["2025-01-02", "2025-01-02T03:04:05", "2025-01-02T03:04:05Z", "2025-01-02 03:04:05", "02/01/2025", None]
    got = over(spark, texts, "string", lambda c: time.format_ts(time.parse_datetime_any(c, strict=False)))
    assert got == ["2025-01-02T00:00:00Z", *["2025-01-02T03:04:05Z"] * 3, None, None]
    with pytest.raises(Exception, match="Cannot parse datetime"):
        over(spark, texts, "string", time.parse_datetime_any)


def test_week_buckets_start_on_monday(spark):
    stamps = [
        datetime(2025, 11, 30, 12),
        datetime(2025, 11, 24),
        datetime(2025, 11, 30, 23, 59, 59),
        datetime(2025, 12, 1),
        datetime(1969, 12, 30),
    ]
    got = over(spark, stamps, "timestamp", lambda c: time.time_bucket("7 days", c))
    assert got == [*[datetime(2025, 11, 24)] * 3, datetime(2025, 12, 1), datetime(1969, 12, 29)]


def test_interval_seconds():
    assert [time.interval_seconds(w) for w in ("7 days", "1 hour", "60 seconds", 5)] == [604800, 3600, 60, 5]
    with pytest.raises(ValueError):
        time.interval_seconds("1 month")


@pytest.mark.parametrize("degrees, expected", [([350.0, 10.0], 0.0), ([200.0, 250.0], -135.0), ([None, None], None)])
def test_circular_mean(spark, degrees, expected):
    df = spark.createDataFrame([(d,) for d in degrees], "d double")
    got = df.select(numeric.circular_mean_deg("d").alias("x")).first().x
    assert got is None if expected is None else abs(got - expected) < 1e-9


def test_opposite_directions_stay_finite(spark):
    df = spark.createDataFrame([(0.0,), (180.0,)], "d double")
    assert math.isfinite(df.select(numeric.circular_mean_deg("d").alias("x")).first().x)


def test_round_numeric_keeps_ties(spark):
    got = over(spark, [2.675, 23.384999999999998, -2.675, 1e-9, None], "double", lambda c: numeric.round_numeric(c, 2))
    assert [None if g is None else float(g) for g in got] == [2.68, 23.39, -2.68, 0.0, None]


def test_threshold_band(spark):
    got = over(spark, [-5.0, 10.0, 24.9, 30.0, 35.0, None], "double",
               lambda c: numeric.threshold_band(c, numeric.TEMPERATURE_BANDS))
    assert got == ["blue", "green", "green", "orange", "red", None]


def test_format_value(spark):
    assert one(spark, numeric.format_value(F.lit(12.34), 1, "hPa")) == "12.3 hPa"
    assert one(spark, numeric.format_value(F.lit(110.0), 0, "")) == "110"
    assert one(spark, numeric.format_value(F.lit(None).cast("double"), 1, "hPa")) == "null"


def test_sea_level_pressure_closes_the_airport_gap(spark):
    airport = one(spark, numeric.sea_level_pressure(F.lit(1003.4), F.lit(73.0)))
    assert abs(airport - 1012.0) < 0.6


def test_haversine_against_plain_python(spark):
    def plain(lat1, lon1, lat2, lon2):
        p1, p2 = math.radians(lat1), math.radians(lat2)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
        return 6371000.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))

    for points in [(39.49, -0.40, 39.47, -0.376), (0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0)]:
        assert abs(one(spark, geo.haversine_m(*points)) - plain(*points)) < 1e-6


def test_ellipsoid_known_lengths(spark):
    # One degree of latitude at the equator and of longitude along it, on WGS84.
    assert abs(one(spark, geo.ellipsoid_m(0.0, 0.0, 1.0, 0.0)) - 110574.39) < 1.0
    assert abs(one(spark, geo.ellipsoid_m(0.0, 0.0, 0.0, 1.0)) - 111319.49) < 0.5
    assert one(spark, geo.ellipsoid_m(39.0, 1.0, 39.0, 1.0)) == 0.0
    assert one(spark, geo.ellipsoid_m(F.lit(None).cast("double"), 1.0, 39.0, 1.0)) is None


def test_extract_lat_lon(spark):
    def wkt(text):
        lat, lon = geo.extract_lat_lon(F.lit(text), "wkt")
        return one(spark, lat), one(spark, lon)

    assert wkt("POINT (-0.405923442529 39.469244235)") == (39.469244, -0.405923)
    assert wkt("point (1 2)") == (None, None)
    assert wkt("x POINT (1 2)") == (None, None)
    assert wkt("POINT (1..2 2)") == (None, None)
    half = F.struct(F.lit(1.0).alias("lat"), F.lit(None).cast("double").alias("lon"))
    lat, lon = geo.extract_lat_lon(half, "struct")
    assert (one(spark, lat), one(spark, lon)) == (None, None)


def test_valid_lat_lon(spark):
    assert one(spark, geo.valid_lat_lon(F.lit(91.0), F.lit(0.0))) is False
    assert one(spark, geo.valid_lat_lon(F.lit(None).cast("double"), F.lit(0.0))) is False
    assert one(spark, geo.valid_lat_lon(F.lit(-90.0), F.lit(180.0))) is True


@pytest.mark.parametrize("lat0, lon0, metres", [(39.47, -0.376, 3000), (60.0, 179.99, 5000), (89.99, 10.0, 4000), (0.0, -179.999, 900)])
def test_bounding_box_never_loses_a_near_point(spark, lat0, lon0, metres):
    made = spark.range(4000).select(
        (F.lit(lat0) + (F.rand(1) - 0.5) * 0.2).alias("lat"), (F.lit(lon0) + (F.rand(2) - 0.5) * 0.4).alias("lon")
    ).select(
        F.least("lat", F.lit(90.0)).alias("lat"),
        F.when(F.col("lon") > 180, F.col("lon") - 360).when(F.col("lon") < -180, F.col("lon") + 360).otherwise(F.col("lon")).alias("lon"),
    )
    near = made.filter(geo.ellipsoid_m("lat", "lon", lat0, lon0) <= metres)
    assert near.filter(~geo.bounding_box("lat", "lon", lat0, lon0, metres)).count() == 0
    assert near.count() > 0


def test_fingerprint_changes_only_with_values(spark):
    cols = ", ".join(f"{c} double" for c in AIR.change_cols)
    df = spark.createDataFrame(
        [(1.0, 2.0, 3.0, 4.0, 5.0, None, "a"), (1.0, 2.0, 3.0, 4.0, 5.0, None, "b"), (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, "a")],
        cols + ", air_quality_summary string",
    )
    a, b, c = [r.fp for r in df.select(value_fingerprint(AIR.change_cols).alias("fp")).collect()]
    assert a == b != c
    assert len(a) == 40 and set(a) <= set("0123456789abcdef")
