import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.functions.fingerprint import value_fingerprint
from skyledger.operators.quality import requeue
from skyledger.operators.windows import station_advances
from skyledger.sources.records import read_event_stream
from skyledger.sources.table import ReadingsTable
from skyledger.spec import AIR, WEATHER
from skyledger.streaming import jobs as X

T0 = datetime(2024, 1, 1)


def land(folder, name, *events):
    folder.mkdir(exist_ok=True)
    lines = []
    for seq, (station, ts, no2) in enumerate(events):
        value = {c: None for c in AIR.columns} | {"fiwareid": station, "ts": ts, "no2": no2}
        lines.append(json.dumps({"key": f"{station}|{ts}", "value": json.dumps(value), "seq": seq}))
    (folder / name).write_text("\n".join(lines))


def run_upsert(spark, tmp_path, table):
    stream = read_event_stream(spark, "json", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"})
    X.stream_upsert(stream, table, str(tmp_path / "ckpt")).awaitTermination()


def test_stream_upsert_restarts_from_its_checkpoint(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    land(tmp_path / "in", "1.json", ("a", "2024-01-01T00:00:00Z", 1.0), ("a", "2024-01-01T00:00:00Z", 2.0))
    run_upsert(spark, tmp_path, table)
    assert rows(table.read(), "fiwareid", "no2") == [("a", 2.0)]
    # Later files: a correction, and a row far older than anything seen.
    land(tmp_path / "in", "2.json", ("a", "2024-01-01T00:00:00Z", None), ("b", "2019-01-01T00:00:00Z", 9.0))
    run_upsert(spark, tmp_path, table)
    assert rows(table.read(), "fiwareid", "no2") == [("a", None), ("b", 9.0)]
    run_upsert(spark, tmp_path, table)
    assert rows(table.read(), "fiwareid", "no2") == [("a", None), ("b", 9.0)]


def test_replayed_batch_leaves_the_table_alone(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    land(tmp_path / "in", "1.json", ("a", "2024-01-01T00:00:00Z", 1.0))
    run_upsert(spark, tmp_path, table)
    before = rows(table.read(), *AIR.columns)
    # Losing the commit of the last batch makes the query run it again.
    for name in ("0", ".0.crc"):
        (tmp_path / "ckpt" / "commits" / name).unlink()
    run_upsert(spark, tmp_path, table)
    assert rows(table.read(), *AIR.columns) == before


@pytest.mark.parametrize("scope, expected", [("dataset", 4), ("station", 5)])
def test_stream_change_capture(spark, tmp_path, scope, expected):
    folder = tmp_path / "in"
    batches = [
        [(1, "A", "2024-01-01T10:00:00Z", 1.0), (2, "B", "2024-01-01T10:00:00Z", 1.0)],
        [(3, "A", "2024-01-01T10:00:00Z", 1.0), (4, "B", "2024-01-01T10:00:00Z", 5.0)],
        [(5, "A", "2024-01-01T11:00:00Z", 1.0), (6, "C", "2024-01-01T09:00:00Z", 1.0)],
    ]
    schema = "_seq long, fiwareid string, ts string, no2 double"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        raw = spark.readStream.schema(schema).parquet(str(folder))
        rest = [F.lit(None).cast("string" if c in AIR.texts else "double").alias(c) for c in AIR.values if c != "no2"]
        canonical = raw.select("*", *rest).withColumn("_fp", value_fingerprint(AIR.change_cols))
        X.stream_emit_changes(
            canonical, str(tmp_path / "s"), str(tmp_path / "out"), AIR, str(tmp_path / "c"), scope=scope
        ).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == expected
    assert out.filter("key = 'B|2024-01-01T10:00:00Z'").count() == 2


def test_stream_rollup_matches_week_starts(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "fiwareid string, ts timestamp, temperature_c double, wind_dir_deg double"
    rows = [("w", datetime(2025, 11, 24), 10.0, 350.0), ("w", datetime(2025, 11, 30, 23), 20.0, 10.0), ("w", datetime(2025, 12, 1), 5.0, 5.0)]
    spark.createDataFrame(rows, schema).write.parquet(folder)
    raw = spark.readStream.schema(schema).parquet(folder)
    rest = [F.lit(None).cast("double").alias(c) for c in WEATHER.metrics if c not in ("temperature_c", "wind_dir_deg")]
    rolled = X.stream_rollup(raw.select("*", *rest), WEATHER, "7 days", "30 days")
    X.write_rollup_stream(rolled, str(tmp_path / "r"), str(tmp_path / "c")).awaitTermination()
    got = {r.bucket_start: r.temp_avg_c for r in X.read_rollup_stream(spark, str(tmp_path / "r"), WEATHER).collect()}
    assert got == {datetime(2025, 11, 24): 15.0, datetime(2025, 12, 1): 5.0}


def test_stream_freshness_remembers(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "dataset string, ts timestamp"
    expected = spark.createDataFrame([("air",), ("weather",)], "dataset string")
    reports = []
    for minute, clock in ((0, 10), (50, 55)):
        name = "air" if minute == 0 else "weather"
        spark.createDataFrame([(name, T0 + timedelta(minutes=minute))], schema).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        X.stream_freshness(
            stream, expected, str(tmp_path / "s"), str(tmp_path / "out"), str(tmp_path / "c"), clock=T0 + timedelta(minutes=clock)
        ).awaitTermination()
        newest = sorted(p.name for p in (tmp_path / "out").glob("batch_id=*"))[-1]
        reports.append({r.dataset: r.state for r in spark.read.parquet(str(tmp_path / "out" / newest)).collect()})
    assert reports == [{"air": "ok", "weather": "firing"}, {"air": "pending", "weather": "ok"}]


def test_snapshot_stream_equals_batch(spark, rows, tmp_path):
    import random

    rng = random.Random(4)
    polls = [
        (p, f"W{s}", T0 + timedelta(minutes=10 * max(0, p + rng.randint(-3, 1) - p % 4)))
        for p in range(12)
        for s in range(3)
        if rng.random() < 0.8
    ]
    schema = "poll_seq long, fiwareid string, ts timestamp"
    folder = str(tmp_path / "in")
    cols = ["poll_seq", "fiwareid", "ts", "last_seen", "advanced", "poll_kind"]
    want = rows(station_advances(spark.createDataFrame(polls, schema)), *cols)
    for lo in range(0, 12, 4):
        part = [r for r in polls if lo <= r[0] < lo + 4]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        X.snapshot_diff_stream(stream, str(tmp_path / "s"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), *cols) == want


@pytest.mark.parametrize("width", ["1 week", "2 days", "14 days", "7 days", "36 hours"])
def test_stream_buckets_equal_batch_buckets(spark, tmp_path, width):
    from skyledger.operators.rollups import BUCKET_NAMES, rollup

    folder = str(tmp_path / "in")
    schema = "fiwareid string, ts timestamp, temperature_c double"
    data = [("w", datetime(2025, 11, 28, 5), 1.0), ("w", datetime(2025, 12, 3, 7), 2.0), ("w", datetime(2025, 12, 11), 4.0)]
    spark.createDataFrame(data, schema).write.parquet(folder)
    rest = [F.lit(None).cast("double").alias(c) for c in WEATHER.metrics if c != "temperature_c"]
    rolled = X.stream_rollup(spark.readStream.schema(schema).parquet(folder).select("*", *rest), WEATHER, width, "30 days")
    X.write_rollup_stream(rolled, str(tmp_path / "r"), str(tmp_path / "c")).awaitTermination()
    got = sorted((r.bucket_start, r.temp_avg_c) for r in X.read_rollup_stream(spark, str(tmp_path / "r"), WEATHER).collect())
    batch = rollup(spark.createDataFrame(data, schema).select("*", *rest), WEATHER, width)
    assert got == sorted((r[BUCKET_NAMES.get(width, "bucket")], r.temp_avg_c) for r in batch.collect())


def test_freshness_counts_rows_behind_those_ahead_of_the_clock(spark, tmp_path):
    from skyledger.operators.quality import freshness

    folder = str(tmp_path / "in")
    schema = "dataset string, ts timestamp"
    expected = spark.createDataFrame([("air",), ("weather",), ("none",)], "dataset string")
    clock = T0 + timedelta(minutes=1)
    parts = [[("air", T0), ("air", T0), ("weather", T0)], [("air", T0), ("weather", T0), ("weather", T0 + timedelta(minutes=2))]]
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        X.stream_freshness(stream, expected, str(tmp_path / "s"), str(tmp_path / "out"), str(tmp_path / "c"), clock=clock).awaitTermination()
    newest = sorted(p.name for p in (tmp_path / "out").glob("batch_id=*"))[-1]
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / newest)).collect())
    whole = freshness(spark.createDataFrame(parts[0] + parts[1], schema), expected, clock)
    assert got == sorted(tuple(r) for r in whole.collect()) == [("air", 3, "ok"), ("none", 0, "firing"), ("weather", 2, "ok")]


def test_state_keeps_two_versions(spark, tmp_path):
    folder = str(tmp_path / "in")
    expected = spark.createDataFrame([("air",)], "dataset string")
    for n in range(5):
        spark.createDataFrame([("air", T0 + timedelta(minutes=n))], "dataset string, ts timestamp").write.mode("append").parquet(folder)
        stream = spark.readStream.schema("dataset string, ts timestamp").parquet(folder)
        X.stream_freshness(stream, expected, str(tmp_path / "s"), str(tmp_path / "out"), str(tmp_path / "c"), clock=T0).awaitTermination()
    assert len(list((tmp_path / "s").glob("version=*"))) <= 2


def test_broken_events_are_kept_apart_or_stop_the_query(spark, rows, tmp_path):
    from skyledger.operators.quality import requeue

    land(tmp_path / "in", "1.json", ("a", "2024-01-01T00:00:00Z", 1.0), ("b", "soon", 2.0))
    with open(tmp_path / "in" / "2.json", "w") as f:
        f.write(json.dumps({"key": "c", "value": '{"fiw', "seq": 1}))
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    stream = lambda: read_event_stream(spark, "json", {"path": str(tmp_path / "in")})
    X.stream_upsert(stream(), table, str(tmp_path / "c"), failed=str(tmp_path / "f")).awaitTermination()
    assert rows(table.read(), "fiwareid", "no2") == [("a", 1.0)]
    waiting, batches = requeue(spark, str(tmp_path / "f"))
    assert sorted(r.key for r in waiting.collect()) == ["b|soon", "c"] and batches == [0]
    strict = ReadingsTable(spark, str(tmp_path / "u"), AIR)
    with pytest.raises(Exception, match="event without station or instant"):
        X.stream_upsert(stream(), strict, str(tmp_path / "c2")).awaitTermination()
    assert strict.read().count() == 0


def test_a_batch_is_parsed_once_for_both_writes(spark, rows, tmp_path):
    """Equal arrival numbers fall back to the values; broken events are kept whole."""
    table, read = ReadingsTable(spark, str(tmp_path / "t"), AIR), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        read.add(1)
        return value

    events = [("a", "2024-01-01T00:00:00Z", 1.0), ("a", "2024-01-01T00:00:00Z", 3.0), ("a", "2024-01-01T00:00:00Z", 2.0), ("b", "soon", 1.0)]
    land(tmp_path / "in", "1.json", *events)
    stream = read_event_stream(spark, "json", {"path": str(tmp_path / "in")}).withColumns({"value": counted("value"), "_seq": F.lit(1)})
    X.stream_upsert(stream, table, str(tmp_path / "ckpt"), failed=str(tmp_path / "failed")).awaitTermination()
    assert read.value == len(events)
    assert rows(table.read(), "fiwareid", "no2") == [("a", 3.0)]
    waiting, _ = requeue(spark, str(tmp_path / "failed"))
    assert [(r.key[:1], json.loads(r.value)["ts"]) for r in waiting.collect()] == [("b", "soon")]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_pieces_are_shuffled_before_they_are_merged(spark, tmp_path):
    """Pieces are unique per key, so there is nothing to combine before the shuffle."""
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    for n in range(2):
        land(tmp_path / "in", f"{n}.json", ("a", "2024-01-01T00:00:00Z", float(n)))
        run_upsert(spark, tmp_path, table)
    text = table.read()._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.rindex("SortAggregate(") < text.index("Exchange hashpartitioning")


def test_a_new_checkpoint_adds_to_the_table(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    for n in range(2):
        land(tmp_path / f"in{n}", "1.json", (f"s{n}", "2024-01-01T00:00:00Z", 1.0))
        stream = read_event_stream(spark, "json", {"path": str(tmp_path / f"in{n}")})
        X.stream_upsert(stream, table, str(tmp_path / f"c{n}")).awaitTermination()
    assert rows(table.read(), "fiwareid") == [("s0",), ("s1",)]


def test_quarantine_of_a_successor(spark, tmp_path):
    """Batch 0 of a new checkpoint neither replaces waiting rows of the old one nor counts as handed on; a batch that runs again
    after its rows were handed on writes nothing."""
    from skyledger.operators.quality import mark_consumed, quarantine, requeue

    failed = str(tmp_path / "f")
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    for n in range(3):
        land(tmp_path / f"in{n}", "1.json", (f"bad{n}", "soon", 1.0))
        stream = read_event_stream(spark, "json", {"path": str(tmp_path / f"in{n}")})
        X.stream_upsert(stream, table, str(tmp_path / f"c{n}"), failed=failed).awaitTermination()
        if n == 1:
            waiting, batches = requeue(spark, failed)
            assert sorted(r.key for r in waiting.collect()) == ["bad0|soon", "bad1|soon"] and list(batches) == [0, 0]
            mark_consumed(spark, failed, batches)
            quarantine(spark.createDataFrame([("again", "x")], "key string, value string"), failed, 0, writer=batches[0].writer)
    waiting, batches = requeue(spark, failed)
    assert [r.key for r in waiting.collect()] == ["bad2|soon"]
    mark_consumed(spark, failed, batches)
    assert requeue(spark, failed)[1] == []


def test_rollup_of_a_successor_is_the_newer_one(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "fiwareid string, ts timestamp, temperature_c double"
    rest = [F.lit(None).cast("double").alias(c) for c in WEATHER.metrics if c != "temperature_c"]
    for n, value in enumerate((10.0, 20.0, 90.0)):
        spark.createDataFrame([("w", T0, value)], schema).coalesce(1).write.mode("append").parquet(folder)
        rolled = X.stream_rollup(spark.readStream.schema(schema).parquet(folder).select("*", *rest), WEATHER, "1 day", "30 days")
        X.write_rollup_stream(rolled, str(tmp_path / "r"), str(tmp_path / f"c{n // 2}")).awaitTermination()
    assert [r.temp_avg_c for r in X.read_rollup_stream(spark, str(tmp_path / "r"), WEATHER).collect()] == [40.0]


def test_changes_of_a_successor(spark, tmp_path):
    """A new checkpoint reads everything again and emits only what is new; the first one's events stay."""
    folder, schema = str(tmp_path / "in"), "_seq long, fiwareid string, ts string, no2 double"
    batches = [[(1, "A", "2024-01-01T10:00:00Z", 1.0)], [(2, "B", "2024-01-01T10:00:00Z", 1.0)], [(3, "A", "2024-01-01T11:00:00Z", 2.0)]]
    for scope in ("dataset", "station"):
        for n, part in enumerate(batches):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder + scope)
            raw = spark.readStream.schema(schema).parquet(folder + scope)
            rest = [F.lit(None).cast("string" if c in AIR.texts else "double").alias(c) for c in AIR.values if c != "no2"]
            canonical = raw.select("*", *rest).withColumn("_fp", value_fingerprint(AIR.change_cols))
            out = str(tmp_path / f"out-{scope}")
            X.stream_emit_changes(canonical, str(tmp_path / f"s-{scope}"), out, AIR, str(tmp_path / f"c{n // 2}-{scope}"), scope=scope).awaitTermination()
        assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["A|2024-01-01T10:00:00Z", "A|2024-01-01T11:00:00Z", "B|2024-01-01T10:00:00Z"]


def test_freshness_fires_on_silence(spark, tmp_path):
    import time

    folder, expected = str(tmp_path / "in"), spark.createDataFrame([("air",)], "dataset string")
    spark.createDataFrame([("air", T0)], "dataset string, ts timestamp").write.parquet(folder)
    states = []
    for minutes in (0, 45, 540):
        time.sleep(1.1)
        stream = spark.readStream.schema("dataset string, ts timestamp").parquet(folder)
        X.stream_freshness(
            stream, expected, str(tmp_path / "s"), str(tmp_path / "out"), str(tmp_path / "c"), clock=T0 + timedelta(minutes=minutes)
        ).awaitTermination()
        report = spark.read.parquet(str(tmp_path / "out"))
        states.append(report.orderBy(F.desc("batch_id")).first()["state"])
    assert states == ["ok", "pending", "firing"]


def test_snapshot_stream_keeps_every_station_and_writes_what_it_saw(spark, rows, tmp_path):
    schema = "poll_seq long, fiwareid string, ts timestamp"
    polls = [(0, s, T0) for s in ("", None, *[f"W{i}" for i in range(50)])]
    polls += [(p, s, T0 + timedelta(minutes=p)) for p in range(1, 6) for s in ("", None, "W1")]
    cols = ["poll_seq", "fiwareid", "ts", "max_tick", "last_seen", "advanced", "poll_kind"]
    want = rows(station_advances(spark.createDataFrame(polls, schema)), *cols)
    run = lambda c: X.snapshot_diff_stream(
        spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "s"), str(tmp_path / "out"), str(tmp_path / c)
    ).awaitTermination()
    for p in range(6):
        spark.createDataFrame([r for r in polls if r[0] == p], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run("c1" if p < 3 else "c2")
    assert rows(spark.read.parquet(str(tmp_path / "out")), *cols) == want
    changes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "s" / "seen").glob("change=*")]
    assert changes and max(changes) == 3
    # Part of the last poll comes once more: the query stops.
    spark.createDataFrame(polls[-1:], schema).write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="poll out of order"):
        run("c2")


def test_changes_fold_into_whole_versions(spark, tmp_path):
    state = X.VersionedState(spark, str(tmp_path / "s"), "k string, v long", "k")
    want = {}
    for run in range(2 * X.CHANGES + 3):
        part = {f"k{run % 5}": run, None: -run}
        want |= part
        state.change(spark.createDataFrame(list(part.items()), "k string, v long"), run)
        state.prune(run)
        assert {r.k: r.v for r in state.before(run + 1).collect()} == want
    assert len(list((tmp_path / "s").glob("*=*"))) <= 2 * X.CHANGES
