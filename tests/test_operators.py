import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.operators import aggregates as A
from skyledger.operators import filters as L
from skyledger.operators import geo as G
from skyledger.operators import joins as J
from skyledger.operators import normalise as N
from skyledger.operators import order as O
from skyledger.operators import quality as Q
from skyledger.operators import reports as P
from skyledger.operators import rollups as U
from skyledger.operators import windows as W
from skyledger.operators.changes import dedup_batch, emit_changes, upsert_dimension
from skyledger.spec import AIR, WEATHER
from skyledger.stations import historical_names, retired_ids, station_dimension

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


# -- normalise


def raw_air(spark, **changes):
    record = dict(
        objectid=10,
        nombre="Olivereta",
        fiwareid="A10_OLIVERETA_60m",
        fecha_carg="2025-10-18T17:00:00+00:00",
        no2=24.0,
        pm10=16.0,
        pm25=7.0,
        calidad_am="Buena",
        geo_point_2d={"lat": 39.46924423509195, "lon": -0.40592344552906795},
    ) | changes
    return spark.createDataFrame([record], AIR.raw_schema)


def test_normalise_air_sample(spark):
    got = N.normalise(raw_air(spark), AIR).first()
    assert (got.fiwareid, got.ts, got.lat, got.lon) == ("A10_OLIVERETA_60m", "2025-10-18T17:00:00Z", 39.469244, -0.405923)
    assert (got.no2, got.o3, got.pm10, got.air_quality_summary) == (24.0, None, 16.0, "Buena")
    assert len(got._fp) == 40


@pytest.mark.parametrize(
    "changes, station",
    [
        ({"fiwareid": None, "objectid": 12}, "obj12"),
        ({"fiwareid": "", "objectid": 12}, "obj12"),
        ({"fiwareid": None, "objectid": 0}, "objna"),
        ({"fiwareid": None, "objectid": None}, "objna"),
    ],
)
def test_station_id_fallbacks(spark, changes, station):
    assert N.normalise(raw_air(spark, **changes), AIR).first().fiwareid == station


def test_normalise_weather_renames(spark):
    raw = spark.createDataFrame(
        [("W01", 180, 3.2, 22.5, 55.0, 1013.2, 0.4, "POINT (-0.38 39.47)", "2025-10-18T17:00:00Z")],
        "fiwareid string, viento_dir int, viento_vel double, temperatur double, humedad_re double, presion_ba double,"
        " precipitac double, geo_point_2d string, fecha_carg string",
    )
    got = N.normalise(raw, WEATHER).first()
    assert (got.wind_dir_deg, got.wind_speed_ms, got.temperature_c, got.humidity_pct) == (180.0, 3.2, 22.5, 55.0)
    assert (got.pressure_hpa, got.precip_mm, got.lat, got.lon) == (1013.2, 0.4, 39.47, -0.38)


def test_choose_and_project(spark):
    df = spark.createDataFrame([("x", "2025-01-01T10:00:00", 1)], "a string, b string, c int")
    assert N.choose_ts_column(df, "b") == "b"
    assert N.choose_ts_column(df, "zz") == "b"
    assert N.choose_ts_column(df, "zz", auto=False) == "zz"
    assert N.choose_ts_column(df.withColumnRenamed("a", "fecha"), "zz") == "fecha"
    assert N.choose_ts_column(df.select("a", "c"), "zz") is None
    assert N.project_available(df, ["c", "q", "a"], "b").columns == ["c", "a", "b"]
    assert N.project_available(df, ["b", "a"], "b").columns == ["b", "a"]


def test_keyed_events_drop_rows_without_instant(spark, rows):
    df = N.normalise(raw_air(spark), AIR).unionByName(N.normalise(raw_air(spark, fecha_carg=None), AIR))
    keyed = N.to_keyed_events(df, AIR)
    assert [r.key for r in keyed.collect()] == ["A10_OLIVERETA_60m|2025-10-18T17:00:00Z"]
    assert "_fp" not in keyed.first().value and '"o3":null' in keyed.first().value


# -- change capture against a small model of the rules


def model_poll(batch, offset, seen):
    emitted, top, memory = [], offset, dict(seen)
    for seq, station, ts, fp in sorted(batch, key=lambda r: (r[2], r[0])):
        if ts > top:
            top, memory = ts, {}
        if ts > offset or (ts == offset and seen.get(station) != fp):
            emitted.append((seq, station, ts, fp))
            memory[station] = fp
    return sorted(emitted), top, memory


@pytest.mark.parametrize("trial", range(6))
def test_emit_changes_matches_the_model(spark, trial):
    rng = random.Random(trial)
    offset, seen = "2024-01-01T05:00:00Z", {}
    seq = 0
    for _ in range(3):
        batch = []
        for _ in range(rng.randint(0, 14)):
            seq += 1
            hour = rng.choice([4, 5, 6, 7] if trial % 2 else [4, 5])
            batch.append((seq, f"A{rng.randint(1, 3)}", f"2024-01-01T{hour:02d}:00:00Z", f"f{rng.randint(0, 2)}"))
        frame = spark.createDataFrame(batch, "_seq long, fiwareid string, ts string, _fp string")
        state = spark.createDataFrame(list(seen.items()), "fiwareid string, _fp string")
        mark = spark.createDataFrame([(offset,)], "offset string")
        changes = emit_changes(frame, mark, state, AIR)
        want, offset, seen = model_poll(batch, offset, seen)
        assert sorted(tuple(r) for r in changes.emitted.collect()) == want
        assert changes.offset.first().offset == offset
        assert {r.fiwareid: r._fp for r in changes.seen.collect()} == seen


def test_lagging_station_by_scope(spark):
    batch = spark.createDataFrame([(1, "A03", "2024-01-01T17:50:00Z", "f")], "_seq long, fiwareid string, ts string, _fp string")
    offset = spark.createDataFrame([("2024-01-01T18:00:00Z",)], "offset string")
    seen = spark.createDataFrame([("A01", "x")], "fiwareid string, _fp string")
    assert emit_changes(batch, offset, seen, AIR).emitted.count() == 0
    own = spark.createDataFrame([("A01", "2024-01-01T18:00:00Z", "x")], "fiwareid string, offset string, _fp string")
    assert emit_changes(batch, offset, own, AIR, scope="station").emitted.count() == 1


def test_dedup_keeps_last_with_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1, 5.0, "x"), ("a", 2, None, None), ("b", 1, 1.0, "y")], "k string, s int, v double, w string")
    assert rows(dedup_batch(df, ["k"], "s")) == [("a", 2, None, None), ("b", 1, 1.0, "y")]


def test_upsert_dimension(spark, rows):
    dim = spark.createDataFrame([("a", "air", 1.0), ("b", "air", 2.0)], "id string, kind string, lat double")
    new = spark.createDataFrame([("b", "weather", None), ("c", "weather", 3.0)], "id string, kind string, lat double")
    got = rows(upsert_dimension(dim, new, "id", ["lat"]))
    assert got == [("a", "air", 1.0), ("b", "air", None), ("c", "weather", 3.0)]


# -- lookups


def test_station_dimension_and_names(spark):
    assert station_dimension(spark).count() == 16
    assert historical_names(spark, "air").count() == 8 and historical_names(spark, "weather").count() == 4
    # Weather rows of a shared name carry the place recorded for the name.
    lat = historical_names(spark, "weather").filter("historical_name = 'Viveros'").first()
    assert (lat.fiwareid, lat.lat) == ("W04_VALENCIADT_10m", 39.47964092480533)


def test_consolidate(spark, rows):
    df = spark.createDataFrame([("W06_VIVERS_10m",), ("W04_VALENCIADT_10m",), ("W_CONSELLERIA_10m",)], "fiwareid string")
    assert rows(J.consolidate_station_ids(df, retired_ids(spark), ["W_CONSELLERIA_10m"])) == [("W04_VALENCIADT_10m",)] * 2


def test_coord_match_against_brute_force(spark, rows):
    rng = random.Random(3)
    left = [(f"L{i:03d}", 39.4 + rng.random() * 0.05, -0.4 + rng.random() * 0.05) for i in range(150)]
    left += [("L900", 39.41, -0.39), ("L901", 39.41, -0.39), ("L902", 95.0, 0.0)]
    right = [(f"R{i:03d}", 39.4 + rng.random() * 0.05, -0.4 + rng.random() * 0.05) for i in range(150)]
    right += [("R900", 39.41, -0.39), ("R901", 39.41, -0.39), ("R902", None, None)]
    # A crowd of places within a few metres, on both sides.
    left += [(f"M{i:03d}", 39.42 + rng.random() * 3e-5, -0.38 + rng.random() * 3e-5) for i in range(60)]
    right += [(f"N{i:03d}", 39.42 + rng.random() * 3e-5, -0.38 + rng.random() * 3e-5) for i in range(60)]
    a = spark.createDataFrame(left, "fiwareid string, lat double, lon double")
    b = spark.createDataFrame(right, "historical_id string, lat double, lon double")
    for metres in (40.0, 400.0):
        got = {r.fiwareid: (r.historical_id, r.distance_m) for r in J.station_coord_match(a, b, metres).collect()}
        pairs = (
            a.filter("lat <= 90")
            .join(b.select("historical_id", F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon")), F.col("r_lat").isNotNull())
            .withColumn("m", J.haversine_m("lat", "lon", "r_lat", "r_lon"))
            .filter(F.col("m") <= metres)
        )
        want = {
            r.fiwareid: (r.best.historical_id, r.best.m)
            for r in pairs.groupBy("fiwareid").agg(F.min(F.struct("m", "historical_id")).alias("best")).collect()
        }
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(abs(got[k][1] - want[k][1]) < 1e-6 for k in want)
        assert got["L900"][0] == got["L901"][0] == "R900"


# -- windows


def test_latest_per_station_keeps_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", at(0), 1.0, "x"), ("a", at(5), None, None), ("b", at(1), 2.0, "y")],
        "fiwareid string, ts timestamp, v double, w string",
    )
    want = [("a", at(5), None, None), ("b", at(1), 2.0, "y")]
    assert rows(W.latest_per_station(df)) == want
    assert rows(W.latest_per_station(df, cols=["v"])) == [r[:3] for r in want]
    assert rows(W.last_not_null(df, "v", "ts", ["fiwareid"])) == [("a", 1.0, at(0)), ("b", 2.0, at(1))]


def test_preceding_max_over_blocks(spark):
    rng = random.Random(5)
    data = [(k, i, rng.choice([None, rng.randint(0, 99)])) for k in "ab" for i in rng.sample(range(500), 120)]
    df = spark.createDataFrame(data, "k string, i long, v int")
    got = {(r.k, r.i): r.m for r in W.preceding_max(df, ["k"], "i", F.col("v"), W.number_block("i", 37), "m").collect()}
    for k, i, _ in data:
        earlier = [v for kk, ii, v in data if kk == k and ii < i and v is not None]
        assert got[k, i] == (max(earlier) if earlier else None)


def model_advances(polls):
    last, top, out = {}, None, []
    for poll in sorted({p for p, _, _ in polls}):
        snap = {s: t for p, s, t in polls if p == poll}
        peak = max(snap.values())
        moved = {s: s not in last or t > last[s] for s, t in snap.items()}
        before = dict(last)
        if top is None or peak > top:
            kind, top = "DATASET ADVANCE", peak
            last.update(snap)
        else:
            kind = "PARTIAL ADVANCE" if any(moved.values()) else "NONE"
            last.update({s: t for s, t in snap.items() if moved[s]})
        out += [(poll, s, t, before.get(s), moved[s], kind) for s, t in snap.items()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_station_advances_match_the_model(spark, rows, seed):
    rng = random.Random(seed)
    polls = [
        (p, f"W{s}", at(10 * max(0, p + rng.randint(-4, 1) - (p % 7))))
        for p in range(40)
        for s in range(4)
        if rng.random() < 0.8
    ]
    df = spark.createDataFrame(polls, "poll_seq long, fiwareid string, ts timestamp")
    got = rows(W.station_advances(df, block=6), "poll_seq", "fiwareid", "ts", "last_seen", "advanced", "poll_kind")
    assert got == model_advances(polls)


@pytest.mark.parametrize("cut", [3, 11])
def test_station_advances_go_on_from_what_is_remembered(spark, rows, cut):
    """Two runs, the second from the first one's tops and memory, equal one run; NULL and empty ids are stations, too."""
    rng = random.Random(cut)
    schema = "poll_seq long, fiwareid string, ts timestamp"
    data = [(p, s, at(rng.randrange(p, p + 6))) for p in range(20) for s in ("a", "b", "", None) if rng.random() < 0.7]
    cols = ("poll_seq", "fiwareid", "ts", "max_tick", "last_seen", "advanced", "poll_kind")
    whole = W.station_advances(spark.createDataFrame(data, schema), block=4).collect()
    early, late = ([r for r in data if (r[0] < cut) == first] for first in (True, False))
    memory, top = {}, max(r[2] for r in early)
    for r in sorted((r for r in whole if r.poll_seq < cut), key=lambda r: r.poll_seq):
        if r.poll_kind == "DATASET ADVANCE" or r.advanced:
            memory[r.fiwareid] = r.ts
    known = spark.createDataFrame(list(memory.items()), "fiwareid string, ts timestamp")
    second = W.station_advances(spark.createDataFrame(late, schema), block=4, top=F.lit(top), remembered=known)
    want = sorted((tuple(r[c] for c in cols) for r in whole if r.poll_seq >= cut), key=repr)
    assert rows(second, *cols) == want


def test_alert_sustained(spark, rows):
    samples = [("x", at(m), v) for m, v in [(0, 0), (1, 1), (2, 1), (3, 1), (4, 0), (5, 1), (1500, 1), (1501, 0)]]
    df = spark.createDataFrame(samples, "k string, ts timestamp, v int")
    got = rows(W.alert_sustained(df, F.col("v") == 1, "2 minutes", ["k"]))
    assert got == [("x", at(1), at(3), 3, 120.0, True), ("x", at(5), at(1500), 2, 89700.0, True)]


def test_tick_gaps_and_summary(spark):
    ticks = [("air", at(m)) for m in (0, 0, 60, 60, 180, 3000)] + [("w", at(0))]
    gaps = W.tick_gaps(spark.createDataFrame(ticks, "d string, ts timestamp"), "d")
    assert sorted(r.gap_hours for r in gaps.collect()) == [1.0, 2.0, 47.0]
    got = A.gap_summary(gaps).first()
    assert (got.advances, got.min_hours, got.max_hours) == (3, 1.0, 47.0)


# -- counters


def test_counter_increase_against_brute_force(spark):
    rng = random.Random(9)
    data = []
    for k in "ab":
        value, minute = 0, 0
        for _ in range(150):
            minute += rng.randint(1, 40)
            value = rng.randint(0, 3) if rng.random() < 0.1 else value + rng.randint(0, 9)
            data.append((k, at(minute), float(value)))
    df = spark.createDataFrame(data, "k string, ts timestamp, value double")
    got = {(r.k, r.ts): r.increase for r in A.counter_increase(df, "2 hours", ["k"], block="3 hours").collect()}
    for k, ts, _ in data:
        inside = [r for r in data if r[0] == k and ts - timedelta(hours=2) < r[1] <= ts]
        grown = sum(b[2] if b[2] < a[2] else b[2] - a[2] for a, b in zip(inside, inside[1:]))
        assert got[k, ts] == grown


def test_counter_rate(spark):
    df = spark.createDataFrame([("k", at(0), 0.0), ("k", at(1), 30.0)], "k string, ts timestamp, value double")
    assert sorted(r.rate for r in A.counter_rate(df, "5 minutes", ["k"]).collect()) == [0.0, 0.1]


# -- aggregates and series


def test_rollup_semantics(spark):
    df = spark.createDataFrame(
        [("w", at(0), 350.0, 1.0, 10.0, 1.0), ("w", at(60), 10.0, None, 20.0, 5.0), ("w", at(1440), None, None, None, None)],
        "fiwareid string, ts timestamp, wind_dir_deg double, wind_speed_ms double, temperature_c double, precip_mm double",
    ).withColumns({"humidity_pct": F.lit(1.0), "pressure_hpa": F.lit(2.0)})
    day = {r.bucket_day: r for r in U.rollup(df, WEATHER, "1 day").collect()}
    first, second = day[T0], day[at(1440)]
    assert (first.temp_avg_c, first.precip_max_mm, first.wind_avg_ms) == (15.0, 5.0, 1.0)
    assert abs(first.wind_avg_deg) < 1e-9 and second.wind_avg_deg is None and second.temp_avg_c is None


def test_interval_bounds(spark):
    df = spark.createDataFrame([(at(0),), (at(60),), (at(120),)], "ts timestamp")
    assert L.last_interval(df, "ts", "1 hour", at(120)).count() == 2
    assert L.last_interval(df, "ts", "1 hour", at(120), strict=True).count() == 1
    assert L.scan_range(df, "ts", at(0), at(120)).count() == 2


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "fiwareid string, ts timestamp, v double")
    assert A.avg_recent(empty, "v", "1 hour", T0).first().avg_v is None
    assert A.max_ts_or_default(empty, default="2020-01-01T00:00:00Z").first().max_ts == "2020-01-01T00:00:00Z"
    assert A.row_count(empty).first().total_rows == 0
    assert A.metric_coverage(empty, ["v"]).first().percent is None


def test_coverage_and_snapshot(spark, rows):
    df = spark.createDataFrame(
        [("a", at(0), 1.0, None), ("a", at(0), None, None), ("b", at(10), 2.0, 3.0), ("", at(10), None, None)],
        "fiwareid string, ts timestamp, x double, y double",
    )
    assert rows(A.coverage_matrix(df, ["x", "y"])) == [("", False, False), ("a", True, False), ("b", True, True)]
    assert A.distinct_stations(df).first().stations == 2
    tick = A.snapshot_tick(df.withColumn("d", F.lit("w")), "d").first()
    assert (tick.max_tick, tick.tick_count, tick.mixed, tick.row_count) == (at(10), 2, True, 4)
    half = {r.metric: r.percent for r in A.metric_coverage(df.filter("fiwareid <> ''"), ["x", "y"], "fiwareid").collect()}
    assert half == {"x": 100.0, "y": 50.0}


def test_contains_ci_is_a_substring_test(spark):
    df = spark.createDataFrame([("Pinus.halepensis", 1), ("pinus", 2), (None, 3)], "name string, n int")
    assert L.contains_ci(df, "name", "S.H").count() == 1
    assert L.contains_ci(df, "name", None).count() == 3


def test_climatology_counts_years(spark):
    daily = spark.createDataFrame(
        [("a", datetime(2021, 12, 1), 2.67), ("a", datetime(2022, 12, 1), 2.68), ("a", datetime(2022, 11, 1), 9.0)],
        "fiwareid string, bucket_day timestamp, temp_avg_c double",
    )
    got = U.climatology(daily, 12, 1, 8, ["temp_avg_c"], day_name="day_of_dec").collect()
    assert [(r.day_of_dec, float(r.temp_avg_c), r.years_of_data) for r in got] == [(1, 2.68, 2)]


def test_sorted_outputs(spark):
    df = spark.createDataFrame([(3, at(0)), (None, at(1)), (1, at(2))], "objectid int, ts timestamp")
    assert [r.objectid for r in O.sort_nulls_last(df).collect()] == [1, 3, None]
    named = df.withColumn("fiwareid", F.lit("s")).withColumn("v", F.lit(1.0))
    assert [r.ts for r in O.latest_n(named, n=2).collect()] == [at(2), at(1)]
    assert [r.time for r in U.long_series(named, "v", "1 hour", at(2)).collect()] == [at(0), at(1), at(2)]


def test_wide_series(spark):
    df = spark.createDataFrame([(T0, "a", 1.0), (T0, "b", 2.0), (at(1), "a", 3.0)], "time timestamp, metric string, value double")
    assert [tuple(r) for r in U.wide_series(df, ["a", "b"]).collect()] == [(T0, 1.0, 2.0), (at(1), 3.0, None)]


def test_delivery_stats(spark):
    df = spark.createDataFrame([(T0, True), (T0, False), (at(2), False)], "ts timestamp, bad boolean")
    got = {r.window_start: (r.success, r.failure, r.failure_ratio) for r in A.delivery_stats(df, F.col("bad")).collect()}
    assert got == {T0: (1, 1, 0.5), at(2): (1, 0, 0.0)}


def test_active_datasets_cover_whole_days(spark, rows):
    df = spark.createDataFrame([("a", at(0)), ("a", at(1440)), ("b", at(2881))], "d string, ts timestamp")
    got = A.active_datasets(df, "d", "ts", at(2900), 60)
    assert rows(got) == [("a", 2)]
    counted = A.count_between(df, "d", "ts", at(0), at(1440), expected=df)
    assert rows(counted) == [("a", 1), ("b", 0)]


# -- places


def test_nearest_and_within(spark, rows):
    dim = station_dimension(spark)
    home = (39.493804279841314, -0.4026670632153834)
    nearest = G.k_nearest(dim, *home, 3).collect()
    assert [r.fiwareid for r in nearest] == ["A03_MOLISOL_60m", "A10_OLIVERETA_60m", "W04_VALENCIADT_10m"]
    assert nearest[0].distance_meters < 1700
    assert rows(G.stations_within(dim, *home, 3000)) == [("A03_MOLISOL_60m",), ("A10_OLIVERETA_60m",)]
    with pytest.raises(ValueError):
        G.k_nearest(dim, *home, 0)
    with pytest.raises(ValueError):
        G.k_nearest(dim, 91.0, 0.0, 1)


# -- quality


CHECKS = [
    ('{"fiwareid":"a","ts":"x"}', []),
    ('{"fiwareid":"a","ts":"x","more":{"no2":"5"}}', []),
    ('{"fiwareid":"a","ts":"x","no2":null,"o3":5,"so2":1.5e3}', []),
    ('{"fiwareid":"a","ts":"x","no2":"5"}', ["no2: '5' is not of type 'number', 'null'"]),
    ('{"fiwareid":"a","ts":"x","no2":"it\'s"}', ['no2: "it\'s" is not of type \'number\', \'null\'']),
    ('{"fiwareid":"a","ts":null}', ["ts: None is not of type 'string'"]),
    ('{"fiwareid":"a"}', ["(root): 'ts' is a required property"]),
    ('{"lat":true,"air_quality_summary":1}', [
        "air_quality_summary: 1 is not of type 'string', 'null'",
        "lat: True is not of type 'number', 'null'",
        "(root): 'fiwareid' is a required property",
        "(root): 'ts' is a required property",
    ]),
    ("5", ["(root): 5 is not of type 'object'"]),
    ("[1]", ["(root): [1] is not of type 'object'"]),
    ("{", ["(root): invalid JSON"]),
]


def test_validation_messages(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CHECKS)], "i int, value string")
    got = Q.with_validation_errors(df, AIR).orderBy("i").collect()
    assert [r.errors for r in got] == [errors for _, errors in CHECKS]


def test_validate_splits_and_counts(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CHECKS)], "i int, value string")
    valid, rejected, counts = Q.validate(df, AIR, index="i")
    assert (valid.count(), rejected.count()) == (3, 8)
    assert tuple(counts.first()) == (3, 8, 11)
    assert rejected.filter("i = 6").first().errors == ["Record 6: (root): 'ts' is a required property"]


def test_strict_mode_checks_the_instant(spark):
    df = spark.createDataFrame([('{"fiwareid":"a","ts":"x"}',), ('{"fiwareid":"a","ts":"2024-01-01T00:00:00Z"}',)], "value string")
    got = [r.errors for r in Q.with_validation_errors(df, AIR, strict=True).collect()]
    assert got == [["ts: 'x' is not a 'date-time'"], []]


def test_freshness_states(spark, rows):
    df = spark.createDataFrame([("air", at(0)), ("weather", at(40)), ("late", at(70))], "dataset string, ts timestamp")
    expected = spark.createDataFrame([("air",), ("weather",), ("late",), ("never",)], "dataset string")
    got = rows(Q.freshness(df, expected, at(80)))
    assert got == [("air", 0, "firing"), ("late", 1, "ok"), ("never", 0, "firing"), ("weather", 0, "pending")]


def test_alert_routing(spark, rows):
    alerts = spark.createDataFrame(
        [("down", "critical", T0), ("down", "warning", T0), ("slow", "warning", T0), ("slow", "warning", at(1))],
        "alertname string, severity string, ts timestamp",
    )
    assert rows(Q.inhibit(alerts), "alertname", "severity") == [("down", "critical"), ("slow", "warning"), ("slow", "warning")]
    assert rows(Q.group_alerts(alerts))[-1] == ("slow", "warning", 2, T0, at(1))


def test_quarantine_and_requeue(spark, rows, tmp_path):
    path = str(tmp_path / "q")
    bad = spark.createDataFrame([("k1", "v1"), ("k2", "v2")], "key string, value string")
    Q.quarantine(bad, path, 3)
    Q.quarantine(bad, path, 3)
    Q.quarantine(bad.limit(1), path, 4)
    waiting, batches = Q.requeue(spark, path)
    assert batches == [3, 4] and waiting.count() == 3
    Q.mark_consumed(spark, path, [3])
    waiting, batches = Q.requeue(spark, path)
    assert batches == [4] and waiting.count() == 1


def test_dead_letter_lines(spark, rows, tmp_path):
    file = tmp_path / "air.jsonl"
    file.write_text('{"key":"a","value":"{}","ts":1.5}\n\n{"key": broken\n{"key":"b","value":"x","ts":2}\n')
    letters, size = Q.read_dead_letters(spark, str(file))
    assert rows(letters, "key", "value") == [("a", "{}"), ("b", "x")]
    assert size.first()["size"] == 3


# -- reports


def test_station_report(spark):
    df = spark.createDataFrame([(1, "W1", 180.0, None, 2.25)], "objectid int, fiwareid string, viento_dir double, temperatur double, other double")
    cat = P.catalogue(spark, P.WEATHER_CATALOGUE)
    got = {r.metric: (r.label, r.shown) for r in P.station_report(df, ["viento_dir", "temperatur", "other"], cat, ["fiwareid"]).collect()}
    assert got == {"viento_dir": ("Wind Dir", "180 °"), "temperatur": ("Temp", "null"), "other": ("other", "2.3")}


def test_null_keys_carry_over_blocks(spark):
    ticks = [(k, datetime(2024, 1, 1, 23, 30)) for k in ("x", None)] + [(k, datetime(2024, 1, 2, 1, 30)) for k in ("x", None)]
    gaps = W.tick_gaps(spark.createDataFrame(ticks, "d string, ts timestamp"), "d").collect()
    assert sorted((str(r.d), r.gap_hours) for r in gaps) == [("None", 2.0), ("x", 2.0)]
    samples = [(k, datetime(2024, 1, 1, 23, 50) + timedelta(minutes=m), v) for k in ("x", None) for m, v in ((0, 1), (4, 0), (8, 1), (16, 1))]
    runs = W.alert_sustained(spark.createDataFrame(samples, "k string, ts timestamp, v int"), F.col("v") == 1, "5 minutes", ["k"]).collect()
    for key in ("x", None):
        assert sorted((r.since.minute, r.until.minute) for r in runs if r.k == key) == [(50, 50), (58, 6)]


def test_stations_without_an_instant_stay_whatever_the_types(spark):
    rows = [("a", None, 1.0, "t"), ("b", datetime(2024, 1, 1), 2.0, "u"), ("b", datetime(2023, 1, 1), 3.0, "v")]
    frame = spark.createDataFrame(rows, "fiwareid string, ts timestamp, no2 double, note string")
    for cols in (["no2"], ["no2", "note"]):
        got = {r.fiwareid: tuple(r)[1:] for r in W.latest_per_station(frame, cols=cols).collect()}
        assert got["a"] == (None,) * (len(cols) + 1) and got["b"][1] == 2.0


def test_partners_over_the_date_line(spark):
    left = spark.createDataFrame([("a", 10.0, 179.9999), ("b", -5.0, -179.9999), ("c", 0.0, 180.0)], "fiwareid string, lat double, lon double")
    right = spark.createDataFrame([("p", 10.0, -179.9999), ("q", -5.0, 179.9999), ("r", 0.0, -180.0)], "historical_id string, lat double, lon double")
    got = sorted((r.fiwareid, r.historical_id, r.distance_m < 23) for r in J.station_coord_match(left, right, 500.0).collect())
    assert got == [("a", "p", True), ("b", "q", True), ("c", "r", True)]


def test_counts_read_only_their_range(spark):
    rows = [("x", datetime(2024, 1, 2)), ("y", datetime(2024, 3, 1)), (None, datetime(2024, 1, 3))]
    frame = spark.createDataFrame(rows, "d string, ts timestamp")
    got = A.count_between(frame, "d", "ts", "2024-01-01", "2024-02-01", expected=frame)
    assert sorted((str(r.d), r.row_count) for r in got.collect()) == [("None", 1), ("x", 1), ("y", 0)]


def test_growth_over_ranges_of_any_length(spark):
    rng = random.Random(8)
    rows = []
    for series in ("x", None):
        at, v = datetime(2024, 1, 1), 0
        for _ in range(120):
            at += timedelta(minutes=rng.choice([1, 7, 50, 400]))
            v = rng.randrange(3) if rng.random() < 0.1 else v + rng.randrange(9)
            rows.append((series, at, float(v)))
    for hours in (1, 30, 24 * 30):
        got = A.counter_increase(spark.createDataFrame(rows, "s string, ts timestamp, value double"), f"{hours} hours", ["s"]).collect()
        assert len(got) == len(rows)
        for r in got:
            mine = [(t, v) for s, t, v in rows if s == r.s and r.ts - timedelta(hours=hours) < t <= r.ts]
            want = sum(b if b < a else b - a for (_, a), (_, b) in zip(mine, mine[1:]))
            assert abs(r.increase - want) < 1e-9
    grown = A.counter_increase(spark.createDataFrame(rows, "s string, ts timestamp, value double"), "1 hour", ["s"])
    expected = spark.createDataFrame([("x",), ("silent",), (None,)], "s string")
    silent = A.with_silent(grown, expected, ["s"], datetime(2024, 2, 1)).filter("s = 'silent'").collect()
    assert [(r.ts, r.increase) for r in silent] == [(datetime(2024, 2, 1), 0.0)]
