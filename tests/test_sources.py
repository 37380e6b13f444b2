import json
import random
import time
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from skyledger.operators.normalise import from_keyed_events
from skyledger.operators import rollups as U
from skyledger.operators.rollups import rollup
from skyledger.plans.newest import latest_stored, newest_instant, newest_rows
from skyledger.plans.rollup_jobs import RollupStore, policy_checks, refresh_from
from skyledger.plans.ingest import backfill, poll, replay, replay_slices, send_events, unmatched_names
from skyledger.plans.rollup_jobs import assert_tables, read_rollup, refresh_rollup, refresh_touched, refresh_window, stored_checks, table_checks
from skyledger.session import require_utc, shared_dir, work_dir
from skyledger.sources import records as S
from skyledger.sources.exports import export_dataset, topk_payload
from skyledger.sources.files import exists, list_names
from skyledger.sources.table import ReadingsTable
from skyledger.spec import AIR, WEATHER
from skyledger.stations import historical_names

T0 = datetime(2024, 1, 1)


def air_rows(spark, *rows):
    """``(station, hours after the start, no2, summary)``."""
    data = [(s, T0 + timedelta(hours=h), no2, text) for s, h, no2, text in rows]
    df = spark.createDataFrame(data, "fiwareid string, ts timestamp, no2 double, air_quality_summary string")
    rest = [c for c in AIR.values if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("double").alias(c) for c in rest])


# -- pages


def page(tmp_path, name, body):
    (tmp_path / name).write_text(body if isinstance(body, str) else json.dumps(body))


def record(station, ts="2025-10-18T18:00:00+00:00", **more):
    return {"fiwareid": station, "fecha_carg": ts, "no2": 1.0, "geo_point_2d": {"lon": -0.4, "lat": 39.4}} | more


def test_page_wrappers(spark, rows, tmp_path):
    page(tmp_path, "p_01.json", {"total_count": 1, "results": [record("A")], "records": [record("no")]})
    page(tmp_path, "p_02.json", [record("B"), record("B2")])
    page(tmp_path, "p_03.json", {"results": "none", "features": [record("C")]})
    page(tmp_path, "p_04.json", {"result": {"records": [record("D")]}})
    page(tmp_path, "p_05.json", {"results": [], "items": [record("no")]})
    page(tmp_path, "p_06.json", {"error": "limit"})
    page(tmp_path, "p_07.json", {"items": [record("E")]})
    got, rejects = S.read_record_pages(spark, str(tmp_path), AIR.raw_schema)
    assert rows(got, "_page", "fiwareid") == [(1, "A"), (2, "B"), (2, "B2"), (3, "C"), (4, "D"), (7, "E")]
    assert [r["key"] for r in rejects.collect()] == ["p_06.json"]
    assert got.filter("fiwareid = 'B2'").first()["_seq"] == (2, "p_02.json", 1)
    assert S.before_first_failure(got, rejects).count() == 5


def test_poll_keeps_pages_before_a_failure(spark, rows, tmp_path):
    page(tmp_path, "p_1.json", {"results": [record("A01"), record("A02")]})
    page(tmp_path, "p_2.json", "oops")
    page(tmp_path, "p_3.json", {"results": [record("A03")]})
    got, rejects = S.read_record_pages(spark, str(tmp_path), AIR.raw_schema)
    offset = spark.createDataFrame([("2025-10-18T17:00:00Z",)], "offset string")
    seen = spark.createDataFrame([], "fiwareid string, _fp string")
    keyed, changes = poll(got, rejects, offset, seen, AIR)
    assert [r[0] for r in rows(keyed, "key")] == ["A01|2025-10-18T18:00:00Z", "A02|2025-10-18T18:00:00Z"]
    assert changes.offset.first().offset == "2025-10-18T18:00:00Z"
    # The same pages polled again from the new state bring nothing.
    again, _ = poll(got, rejects, changes.offset, changes.seen, AIR)
    assert again.count() == 0


def test_poll_ignores_a_new_summary_text(spark, tmp_path):
    page(tmp_path, "p_1.json", [record("A01", calidad_am="Buena")])
    first, none = S.read_record_pages(spark, str(tmp_path), AIR.raw_schema)
    offset = spark.createDataFrame([("2025-10-18T17:00:00Z",)], "offset string")
    _, changes = poll(first, none, offset, spark.createDataFrame([], "fiwareid string, _fp string"), AIR)
    renamed = first.withColumn("calidad_am", F.lit("Mala"))
    assert poll(renamed, None, changes.offset, changes.seen, AIR)[0].count() == 0
    moved = first.withColumn("no2", F.lit(2.0))
    assert poll(moved, None, changes.offset, changes.seen, AIR)[0].count() == 1


@pytest.mark.parametrize(
    "text, stations",
    [
        ('[{"fiwareid":"a"},{"fiwareid":"b"}]', ["a", "b"]),
        ('{\n "fiwareid": "a"\n}', ["a"]),
        ('{"fiwareid":"a"}\n\n{"fiwareid":"b"}\n', ["a", "b"]),
        ("\n", []),
    ],
)
def test_json_layouts(spark, tmp_path, text, stations):
    (tmp_path / "in.json").write_text(text)
    got = S.read_json_or_ndjson(spark, str(tmp_path / "in.json"), AIR.raw_schema)
    assert sorted(r.fiwareid for r in got.collect()) == stations


def test_json_lines_reject_non_objects(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"fiwareid":"a"}\n5\n{"fiw\n')
    path = str(tmp_path / "in.json")
    assert S.read_json_or_ndjson(spark, path, AIR.raw_schema, strict=False).count() == 1
    with pytest.raises(Exception, match="not a JSON object"):
        S.read_json_or_ndjson(spark, path, AIR.raw_schema).collect()


@pytest.mark.parametrize("first", ['{"fiwareid": "x",', "[", '{"a": 1} {"b": 2}', '"text', "5", '{"a": 1}]', "[]"])
def test_a_cut_first_line_costs_that_line(spark, tmp_path, first):
    (tmp_path / "in.json").write_text(first + '\n{"fiwareid": "b"}\n\n{"fiwareid": "c"}\n')
    path = str(tmp_path / "in.json")
    got = S.read_json_or_ndjson(spark, path, AIR.raw_schema, strict=False)
    assert sorted(r.fiwareid for r in got.collect()) == ["b", "c"]
    with pytest.raises(Exception, match="not a JSON object"):
        S.read_json_or_ndjson(spark, path, AIR.raw_schema).collect()


@pytest.mark.parametrize(
    "lines, tried",
    [
        (['{"fiwareid": "x", "no', '{"fiwareid": "b"}', ' {"fiwareid": "c"}\t', '{"fiwareid": "d"}'], False),
        (['{"fiwareid":', '"b"', "}"], True),
        (['[{"fiwareid": "b"}', ', {"fiwareid": "c"}', "", "\t", ',{"fiwareid"', ': "d"}', "]"], True),
    ],
)
def test_files_of_lines_are_not_read_whole(spark, tmp_path, monkeypatch, lines, tried):
    """A cut first line makes no document of a file whose other lines can't go on from one another."""
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    whole, plain = [], DataFrameReader.text

    def text(reader, paths, wholetext=False, **more):
        whole.append(wholetext)
        return plain(reader, paths, wholetext=wholetext, **more)

    monkeypatch.setattr(DataFrameReader, "text", text)
    got = S.read_json_or_ndjson(spark, str(tmp_path / "in.json"), AIR.raw_schema, strict=False)
    assert sorted(r.fiwareid for r in got.collect()) == ["b", "c", "d"][: 1 if len(lines) == 3 else 3]
    assert any(whole) == tried


def test_dataset_of_file(spark):
    names = spark.createDataFrame([("vias_full_2025.json",), ("arbol_metadata_1.json",), ("plain.json",)], "f string")
    assert [r.d for r in names.select(S.dataset_of_file("f").alias("d")).collect()] == ["vias", "arbol", "plain"]


HISTORY = """fecha,hora,estacion,no2,o3,pm2_5,temperatura,direccion_del_viento
2021-01-01,10:00,Viveros,1.5,,7,20.5,90
2021-01-01,10:00,Viveros,2.5,null,8,21.5,95
2021-01-01,11:00,Bulevard Sud,3,x,,,
2021-01-01,11:00,Nazaret Meteo,,,,19,180
2021-01-01,11:00,Conselleria Meteo,1,1,1,1,1
bad,11:00,Viveros,1,1,1,1,1
2021-01-02,,Viveros,4,,,n/a,10
"""


def test_backfill_both_datasets_from_one_file(spark, rows, tmp_path):
    (tmp_path / "h.csv").write_text(HISTORY)
    history = S.read_history_csv(spark, str(tmp_path / "h.csv"))
    air = backfill(history, historical_names(spark, "air"), AIR)
    assert rows(air.rows, "fiwareid", "no2", "o3", "pm25") == [
        ("A02_BULEVARDSUD_60m", 3.0, None, None),
        ("A06_VIVERS_60m", 1.5, None, 7.0),
        ("A06_VIVERS_60m", 2.5, None, 8.0),
        ("A06_VIVERS_60m", 4.0, None, None),
    ]
    assert tuple(air.report.first()) == (4, 3)
    weather = backfill(history, historical_names(spark, "weather"), WEATHER)
    assert rows(weather.rows, "fiwareid", "temperature_c") == [
        ("W02_NAZARET_10m", 19.0),
        ("W04_VALENCIADT_10m", 20.5),
        ("W04_VALENCIADT_10m", 21.5),
    ]
    assert tuple(weather.report.first()) == (3, 4)
    assert rows(unmatched_names(history, historical_names(spark, "air"))) == [("Conselleria Meteo", 1), ("Nazaret Meteo", 1)]


# -- the table


def test_upsert_last_write_wins_with_nulls(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x"), ("b", 0, 2.0, "y")), 0)
    table.upsert(air_rows(spark, ("a", 0, None, "z")), 1)
    assert rows(table.read(), "fiwareid", "no2", "air_quality_summary") == [("a", None, "z"), ("b", 2.0, "y")]
    # A backfill statement leaves the summary alone, but its NULL metrics count.
    table.upsert(air_rows(spark, ("b", 0, None, "ignored"), ("c", 0, 3.0, "ignored")), 2, cols=AIR.metrics)
    want = [("a", None, "z"), ("b", None, "y"), ("c", 3.0, None)]
    assert rows(table.read(), "fiwareid", "no2", "air_quality_summary") == want
    table.compact()
    assert rows(table.read(), "fiwareid", "no2", "air_quality_summary") == want


def test_upsert_in_batch_order_and_retry(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    batch = air_rows(spark, ("a", 0, 1.0, "x")).withColumn("n", F.lit(2)).unionByName(
        air_rows(spark, ("a", 0, 5.0, "y")).withColumn("n", F.lit(1))
    )
    for _ in range(2):
        table.upsert(batch, 0, seq="n")
    assert rows(table.read(), "fiwareid", "no2") == [("a", 1.0)]


def test_compaction_is_invisible_and_partial(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    hours = [0, 5, 24 * 8, 24 * 15]
    for batch in range(3):
        table.upsert(air_rows(spark, *[("a", h, float(batch * 100 + h), "t") for h in hours[batch:]]), batch)
    before = rows(table.read(), "ts", "no2")
    assert table.compact(before=date(2024, 1, 15)) == [date(2024, 1, 1), date(2024, 1, 8)]
    assert rows(table.read(), "ts", "no2") == before
    gone = table.vacuum(grace=timedelta(0))
    assert gone and rows(table.read(), "ts", "no2") == before
    # A late row for a folded chunk, then a second compaction.
    table.upsert(air_rows(spark, ("a", 0, 7.0, "late")), 9)
    table.compact()
    table.vacuum()
    got = dict(rows(table.read(), "ts", "no2"))
    assert got[T0] == 7.0 and len(got) == 4
    assert table.compact() == []


def test_uncommitted_rows_are_not_read(spark, tmp_path, monkeypatch):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x")), 0)
    monkeypatch.setattr(ReadingsTable, "_commit", lambda self, change: False)
    assert not table.upsert(air_rows(spark, ("a", 0, 9.0, "x")), 1)
    assert [r.no2 for r in table.read().collect()] == [1.0]


def test_two_writers_number_their_own_batches(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    assert table.upsert(air_rows(spark, ("a", 0, 1.0, "x")), 0, writer="backfill")
    assert table.upsert(air_rows(spark, ("b", 0, 2.0, "x")), 0, writer="stream")
    assert not table.upsert(air_rows(spark, ("b", 0, 9.0, "x")), 0, writer="stream")
    assert rows(table.read(), "fiwareid", "no2") == [("a", 1.0), ("b", 2.0)]


def test_a_batch_that_comes_after_a_compaction_is_read(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x")), 6)
    table.upsert(air_rows(spark, ("a", 0, 7.0, "x")), 7)
    table.compact()
    table.upsert(air_rows(spark, ("b", 0, 3.0, "x")), 3)
    assert rows(table.read(), "fiwareid", "no2") == [("a", 7.0), ("b", 3.0)]


def test_commits_during_a_compaction_survive_it(spark, rows, tmp_path, monkeypatch):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    for n in range(2):
        table.upsert(air_rows(spark, ("a", 0, float(n), "x")), n)
    real = ReadingsTable._store

    def slow(self, frame, sort=False):
        out = real(self, frame, sort)
        if sort:
            monkeypatch.setattr(ReadingsTable, "_store", real)
            ReadingsTable(spark, self.path, AIR).upsert(air_rows(spark, ("a", 0, 9.0, "x"), ("b", 0, 5.0, "x")), 2)
        return out

    monkeypatch.setattr(ReadingsTable, "_store", slow)
    assert table.compact() == [date(2024, 1, 1)]
    assert rows(table.read(), "fiwareid", "no2") == [("a", 9.0), ("b", 5.0)]
    table.vacuum()
    assert rows(table.read(), "fiwareid", "no2") == [("a", 9.0), ("b", 5.0)]


def test_keys_are_unique_without_a_sequence(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x"), ("a", 0, 2.0, "x"), ("a", 0, None, "y")), 0)
    before = rows(table.read(), "fiwareid", "no2")
    table.compact()
    assert len(before) == 1 and rows(table.read(), "fiwareid", "no2") == before


def test_reading_costs_no_more_with_more_batches(spark, tmp_path, monkeypatch):
    from skyledger.sources import table as module

    table, calls = ReadingsTable(spark, str(tmp_path / "t"), AIR), []
    for name in ("exists", "list_names", "read_text"):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, f=real: calls.append(f) or f(*a))

    def cost():
        calls.clear()
        table.read()
        return len(calls)

    table.upsert(air_rows(spark, ("a", 0, 1.0, "x")), 0)
    first = cost()
    for n in range(1, 5):
        table.upsert(air_rows(spark, ("a", 0, 1.0, "x")), n)
    assert cost() == first
    table.compact()
    table.vacuum(grace=timedelta(0))
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1 and len(list((tmp_path / "t" / "commits").glob("*.json"))) == 1


def test_a_lost_hint_does_no_harm(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    for n in range(3):
        table.upsert(air_rows(spark, ("a", 0, float(n), "x")), n)
    for name in ("latest", ".latest.crc"):
        (tmp_path / "t" / "commits" / name).unlink()
    assert rows(table.read(), "no2") == [(2.0,)]


def test_range_read_touches_only_its_chunks(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x"), ("a", 24 * 9, 2.0, "x"), ("a", 24 * 20, 3.0, "x")), 0)
    got = table.read(datetime(2024, 1, 9), datetime(2024, 1, 11))
    assert rows(got, "no2") == [(2.0,)]
    assert all("chunk_start=2024-01-08" in f for f in got.inputFiles())


def test_retention_drops_whole_old_chunks(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x"), ("a", 24 * 6, 2.0, "x"), ("a", 24 * 8, 3.0, "x")), 0)
    table.upsert(air_rows(spark, ("b", 1, 1.0, "x")), 1)
    table.compact()
    # The first chunk ends on the 8th: with seven days kept it goes on the 15th, not before.
    assert table.retention(datetime(2024, 1, 14, 23), 7) == []
    east = timezone(timedelta(hours=2))
    assert table.retention(datetime(2024, 1, 15, 1, tzinfo=east), 7) == []
    assert table.retention(datetime(2024, 1, 15, 2, tzinfo=east), 7) == [date(2024, 1, 1)]
    assert rows(table.read(), "no2") == [(3.0,)]


def test_deleted_stations_stay_away_through_compaction(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    gone = spark.createDataFrame([("a",), ("z",), (None,)], "fiwareid string")
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x"), ("b", 0, 2.0, "x"), ("a", 24 * 9, 3.0, "x")), 0)
    assert table.delete(gone, 1) and not table.delete(gone, 1)
    assert rows(table.read(), "fiwareid", "no2") == [("b", 2.0)]
    table.upsert(air_rows(spark, ("a", 1, 5.0, "x")), 2)
    table.upsert(air_rows(spark, ("a", 0, 7.0, "late")), 3, cols=["no2"])
    want = [("a", 0, 7.0, None), ("a", 1, 5.0, "x"), ("b", 0, 2.0, "x")]
    hours = lambda: sorted((r.fiwareid, int((r.ts - T0).total_seconds() // 3600), r.no2, r.air_quality_summary) for r in table.read().collect())
    assert hours() == want
    table.compact(before=date(2024, 1, 8))
    assert hours() == want and table.state().deleted
    # The last chunk that held deleted rows is folded, and nothing is left to remember.
    table.compact()
    assert hours() == want and not table.state().deleted
    table.vacuum(grace=timedelta(0))
    assert hours() == want


def test_renamed_stations(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("old", 0, 1.0, None), ("new", 0, 2.0, "own"), ("old", 5, 3.0, "x"), ("p", 0, 4.0, "x"), ("q", 0, 5.0, "x")), 0)
    mapping = spark.createDataFrame([("old", "new"), ("p", "q"), ("q", "p"), ("none", "new"), ("r", "r")], "old_id string, new_id string")
    assert table.rename(mapping, 1) and not table.rename(mapping, 1)
    want = [("new", 1.0, None), ("new", 3.0, "x"), ("p", 5.0, "x"), ("q", 4.0, "x")]
    for _ in range(2):
        assert rows(table.read(), "fiwareid", "no2", "air_quality_summary") == want
        table.compact()
    table.upsert(air_rows(spark, ("old", 0, 9.0, "x")), 2)
    assert rows(table.read(), "fiwareid", "no2") == sorted([*[w[:2] for w in want], ("old", 9.0)])


def test_a_rename_includes_what_is_committed_meanwhile(spark, rows, tmp_path, monkeypatch):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("old", 0, 1.0, "x")), 0)
    real = ReadingsTable._store

    def slow(self, frame, sort=False):
        out = real(self, frame, sort)
        monkeypatch.setattr(ReadingsTable, "_store", real)
        ReadingsTable(spark, self.path, AIR).upsert(air_rows(spark, ("old", 0, 8.0, "x"), ("old", 1, 9.0, "x")), 1)
        return out

    monkeypatch.setattr(ReadingsTable, "_store", slow)
    table.rename(spark.createDataFrame([("old", "new")], "old_id string, new_id string"), 2)
    assert rows(table.read(), "fiwareid", "no2") == [("new", 8.0), ("new", 9.0)]


def test_open_reads_survive_and_lost_folders_go(spark, rows, tmp_path, monkeypatch):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    for n in range(2):
        table.upsert(air_rows(spark, ("a", n, float(n), "x")), n)
    opened = table.read()
    table.compact()
    assert table.vacuum() == [] and rows(opened, "no2") == [(0.0,), (1.0,)]
    # A writer dies between storing and committing.
    with monkeypatch.context() as m:
        m.setattr(ReadingsTable, "_commit", lambda self, change: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            table.upsert(air_rows(spark, ("b", 0, 9.0, "x")), 9)
    assert table.vacuum() == []
    gone = table.vacuum(grace=timedelta(0), abandoned=timedelta(0))
    assert len(gone) == 3 and len(list((tmp_path / "t" / "data").iterdir())) == 1
    assert rows(table.read(), "no2") == [(0.0,), (1.0,)]


def test_policies_are_kept_with_the_table(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x"), ("a", 24 * 20, 2.0, "x")), 0)
    table.set_policies(retention_days=7)
    found = policy_checks({"air": table}, {"air": {"retention_days": 8, "chunk_days": 7, "other": 1}})
    assert rows(found, "policy", "kept", "as_expected") == [("chunk_days", 7, True), ("other", None, False), ("retention_days", 7, False)]
    assert table.retention(datetime(2024, 1, 22)) == [date(2024, 1, 1)]


def test_newest_rows_come_from_the_newest_chunks(spark, rows, tmp_path, monkeypatch):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    weeks = 16
    table.upsert(air_rows(spark, *[(s, 24 * 7 * w, float(w), "x") for w in range(weeks) for s in ("a", "b")], ("silent", 24 * 7 * 12, 0.5, "y")), 0)
    read, real = [], ReadingsTable._load
    monkeypatch.setattr(ReadingsTable, "_load", lambda self, chunks: read.append(sorted(chunks)) or real(self, chunks))
    names = lambda *s: spark.createDataFrame([(x,) for x in s], "fiwareid string")
    assert rows(latest_stored(table, names("a", "b"), ["no2"]), "fiwareid", "no2") == [("a", 15.0), ("b", 15.0)]
    assert [len(x) for x in read] == [1]
    read.clear()
    assert rows(latest_stored(table, names("a", "b", "silent"), ["no2"]), "fiwareid", "no2") == [("a", 15.0), ("b", 15.0), ("silent", 0.5)]
    assert [len(x) for x in read] == [1, 2, 4]
    assert len(rows(latest_stored(table, names("a", "never")))) == 1
    read.clear()
    assert [r.no2 for r in newest_rows(table, 3).collect()] == [15.0, 15.0, 14.0] and max(map(len, read)) == 3
    assert newest_instant(table) == T0 + timedelta(weeks=15)
    table.delete(names("a", "b"), 1)
    assert newest_instant(table) == T0 + timedelta(weeks=12)
    empty = ReadingsTable(spark, str(tmp_path / "u"), AIR)
    assert newest_instant(empty) is None and rows(latest_stored(empty, names("a"))) == [] and rows(newest_rows(empty, 3)) == []


def test_replay_round_trip(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    table.upsert(air_rows(spark, ("b", 2, 2.0, "y"), ("a", 1, 1.0, "x"), ("c", 9, 3.0, "z")), 0)
    keyed = replay(table.read(), AIR, T0, T0 + timedelta(hours=9))
    assert [r["key"] for r in keyed.collect()] == ["a|2024-01-01T01:00:00Z", "b|2024-01-01T02:00:00Z"]
    assert replay(table.read(), AIR, T0, T0 + timedelta(hours=9), dry_run=True).first().events == 2
    second = ReadingsTable(spark, str(tmp_path / "u"), AIR)
    second.upsert(from_keyed_events(keyed, AIR), 0)
    assert rows(second.read(), "fiwareid", "no2") == [("a", 1.0), ("b", 2.0)]


def test_replay_in_slices_goes_on_where_it_stopped(spark, tmp_path):
    data = air_rows(spark, *[(s, h, float(h), "x") for h in range(0, 40, 2) for s in "ab"])
    out, calls, mark = tmp_path / "out", [], str(tmp_path / "mark.json")

    def send(keyed, number, fail=None):
        calls.append(number)
        keyed.coalesce(1).write.mode("overwrite").json(str(out / f"slice={number:03d}"))
        if number == fail:
            raise ConnectionError

    args = (data, AIR, T0, T0 + timedelta(hours=39))
    with pytest.raises(ConnectionError):
        replay_slices(*args, lambda k, n: send(k, n, 3), mark, "5 hours")
    began = time.monotonic()
    sent = replay_slices(*args, send, mark, "5 hours", per_second=20.0)
    assert calls == [0, 1, 2, 3, 3, 4, 5, 6, 7] and replay_slices(*args, send, mark, "5 hours") == 0 and len(calls) == 9
    assert time.monotonic() - began >= sent / 20
    keys = [json.loads(line)["key"] for f in sorted(out.glob("slice=*/part-*.json")) for line in f.read_text().splitlines()]
    assert keys == [r["key"] for r in replay(data, AIR, *args[2:]).collect()] and len(set(keys)) == 40
    with pytest.raises(ValueError, match="another replay"):
        replay_slices(*args, send, mark, "6 hours")


def test_send_events_appends(spark, tmp_path):
    keyed = replay(air_rows(spark, ("a", 1, 1.0, "x")), AIR)
    for _ in range(2):
        send_events(keyed, "json", path=str(tmp_path / "topic"))
    assert spark.read.json(str(tmp_path / "topic")).count() == 2


# -- rollups on disk


def test_refresh_window_holds_whole_buckets():
    now = datetime(2024, 1, 31, 6)
    assert refresh_window("1 day", "30 days", "1 day", now) == (datetime(2024, 1, 2), datetime(2024, 1, 30))
    assert refresh_window("7 days", "30 days", "1 day", now) == (datetime(2024, 1, 8), datetime(2024, 1, 29))


def test_weeks_merge_from_days(spark, rows, tmp_path):
    """Means, maxima and mean directions of merged states are those of the raw rows, NULLs included."""
    rng = random.Random(6)
    data = [
        (rng.choice("ab"), T0 + timedelta(hours=rng.randrange(24 * 30)), *[rng.choice([None, rng.uniform(0, 350)]) for _ in range(6)]) for _ in range(300)
    ] + [("c", T0, *[None] * 6)]
    df = spark.createDataFrame(data, "fiwareid string, ts timestamp, " + ", ".join(f"{m} double" for m in WEATHER.metrics))
    for width in ("7 days", "14 days"):
        merged = U.merge_states(U.rollup_states(df, WEATHER, "1 day"), WEATHER, "bucket_day", width)
        name = U.BUCKET_NAMES.get(width, "bucket")
        close = lambda d: sorted((r.fiwareid, r[name], *[x if x is None else round(x, 9) for x in tuple(r)[2:]]) for r in d.collect())
        assert close(U.finish_states(merged, WEATHER, name)) == close(rollup(df, WEATHER, width))


def test_a_refresh_is_seen_whole_or_not_at_all(spark, rows, tmp_path):
    path = str(tmp_path / "r")
    old = air_rows(spark, *[("a", 24 * d, 1.0, "x") for d in range(4)])
    refresh_rollup(old, path, AIR, "1 day", as_of=datetime(2024, 1, 6))
    opened = read_rollup(spark, path, AIR)
    refresh_rollup(old.withColumn("no2", F.lit(9.0)), path, AIR, "1 day", as_of=datetime(2024, 1, 6))
    store = RollupStore(spark, path, AIR)
    assert store.vacuum() == []
    assert rows(opened, "no2_avg") == [(1.0,)] * 4 and rows(read_rollup(spark, path, AIR), "no2_avg") == [(9.0,)] * 4
    assert len(store.vacuum(grace=timedelta(0))) == 4 and rows(read_rollup(spark, path, AIR), "no2_avg") == [(9.0,)] * 4


def test_late_commits_and_deletions_make_only_their_buckets_again(spark, rows, tmp_path):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    daily, weekly = RollupStore(spark, str(tmp_path / "d"), AIR), RollupStore(spark, str(tmp_path / "w"), AIR, "7 days")
    table.upsert(air_rows(spark, *[(s, 24 * d, float(d), "x") for d in range(0, 28, 3) for s in "ab"]), 0)

    def both():
        days = refresh_touched(table, daily.path)
        weeks = refresh_from(daily, weekly)
        for store, width, name in ((daily, "1 day", "bucket_day"), (weekly, "7 days", "bucket_week")):
            want = rows(rollup(table.read(), AIR, width), "fiwareid", name, "no2_avg")
            assert rows(read_rollup(spark, store.path, AIR, width), "fiwareid", name, "no2_avg") == want
        return len(days), len(weeks)

    assert both() == (4, 4) and both() == (0, 0)
    pieces = dict(daily.state().parts)
    table.upsert(air_rows(spark, ("a", 24 * 9, 50.0, "late"), ("c", 24 * 8, 7.0, "late")), 1)
    assert both() == (1, 1)
    assert {p for p, piece in daily.state().parts.items() if pieces.get(p) != piece} == {"20240109000000", "20240110000000", "20240113000000"}
    table.compact()
    assert both() == (0, 0)
    table.delete(spark.createDataFrame([("a",)], "fiwareid string"), 2)
    assert both() == (4, 4) and both() == (0, 0)
    table.compact()
    assert both()[0] == 0


def test_a_refresh_that_was_overtaken_changes_nothing(spark, rows, tmp_path, monkeypatch):
    table = ReadingsTable(spark, str(tmp_path / "t"), AIR)
    path, real = str(tmp_path / "r"), RollupStore.replace
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x")), 0)

    def slow(self, states, old, mark=None):
        monkeypatch.setattr(RollupStore, "replace", real)
        table.upsert(air_rows(spark, ("a", 0, 5.0, "x")), 1)
        refresh_touched(table, path)
        return self.replace(states, old, mark)

    monkeypatch.setattr(RollupStore, "replace", slow)
    refresh_touched(table, path)
    assert rows(read_rollup(spark, path, AIR), "no2_avg") == [(5.0,)]


def test_incremental_refresh_equals_full_rollup(spark, rows, tmp_path):
    path = str(tmp_path / "r")
    early = air_rows(spark, ("a", 0, 1.0, "x"), ("a", 30, 2.0, "x"), ("b", 50, 4.0, "x"))
    late = early.unionByName(air_rows(spark, ("a", 31, 6.0, "x"), ("b", 80, 8.0, "x")))
    refresh_rollup(early, path, AIR, "1 day", as_of=datetime(2024, 1, 5))
    refresh_rollup(late, path, AIR, "1 day", as_of=datetime(2024, 1, 6))
    want = rows(rollup(late, AIR, "1 day"), "fiwareid", "bucket_day", "no2_avg")
    assert rows(read_rollup(spark, path, AIR), "fiwareid", "bucket_day", "no2_avg") == want
    # Readings that vanish take their bucket with them; buckets before the window stay.
    refresh_rollup(late.filter("fiwareid = 'a'"), path, AIR, "1 day", "2 days", as_of=datetime(2024, 1, 6))
    left = rows(read_rollup(spark, path, AIR), "fiwareid", "bucket_day")
    assert left == [("a", T0), ("a", T0 + timedelta(days=1)), ("b", T0 + timedelta(days=2))]


def test_realtime_rollup_adds_fresh_buckets(spark, rows, tmp_path):
    path = str(tmp_path / "r")
    data = air_rows(spark, ("a", 0, 1.0, "x"), ("a", 24, 2.0, "x"), ("a", 49, 3.0, "x"))
    refresh_rollup(data, path, AIR, "1 day", as_of=datetime(2024, 1, 4, 5))
    assert read_rollup(spark, path, AIR).count() == 2
    assert rows(read_rollup(spark, path, AIR, "1 day", data, realtime=True), "no2_avg") == [(1.0,), (2.0,), (3.0,)]


def test_table_checks(spark):
    spark.range(1).createOrReplaceTempView("present_view")
    got = {r.table_name: (r.present, r.missing_columns) for r in table_checks(spark, {"present_view": ["id"], "no_view": ["a"]}).collect()}
    assert got == {"present_view": (True, []), "no_view": (False, ["a"])}
    with pytest.raises(ValueError, match="no_view"):
        assert_tables(spark, {"no_view": ["a"]})


def test_only_touched_chunks_are_refreshed(spark, rows, tmp_path):
    table, path = ReadingsTable(spark, str(tmp_path / "t"), AIR), str(tmp_path / "r")
    assert refresh_touched(table, path) == []
    table.upsert(air_rows(spark, ("a", 0, 1.0, "x"), ("a", 24 * 8, 2.0, "x"), ("a", 24 * 20, 3.0, "x")), 0)
    assert len(refresh_touched(table, path)) == 3
    table.upsert(air_rows(spark, ("a", 24 * 8 + 1, 4.0, "x")), 1)
    assert refresh_touched(table, path) == [date(2024, 1, 8)]
    table.compact()
    assert refresh_touched(table, path) == []
    assert rows(read_rollup(spark, path, AIR), "no2_avg") == rows(rollup(table.read(), AIR, "1 day"), "no2_avg") == [(1.0,), (3.0,), (3.0,)]


def test_poll_sends_requeued_rows_again(spark, rows, tmp_path):
    page(tmp_path, "p_1.json", [record("A01")])
    first, none = S.read_record_pages(spark, str(tmp_path), AIR.raw_schema)
    offset = spark.createDataFrame([("2025-10-18T17:00:00Z",)], "offset string")
    seen = spark.createDataFrame([], "fiwareid string, _fp string")
    failed = spark.createDataFrame([("old", "{}", T0)], "key string, value string, ts timestamp")
    keyed, _ = poll(first, none, offset, seen, AIR, requeued=failed)
    assert [r[0] for r in rows(keyed, "key")] == ["A01|2025-10-18T18:00:00Z", "old"]


def test_stored_tables_are_checked_by_their_rows(spark):
    rows = air_rows(spark, ("a", 0, 1.0, "x"), ("b", 24 * 30, 2.0, "x"))
    got = stored_checks({"air": rows, "other": rows.select("no2")}, {"air": ["ts", "gone"], "other": []}, {"air": "ts"}, {"air": 10}, datetime(2024, 2, 1))
    assert sorted(tuple(r) for r in got.collect()) == [("air", 2, "gone", 1), ("other", 2, "", 0)]


def test_bounds_prune_rollup_folders(spark, rows, tmp_path):
    path = str(tmp_path / "r")
    data = air_rows(spark, ("a", 0, 1.0, "x"), ("a", 24, 2.0, "x"), ("a", 49, 3.0, "x"))
    refresh_rollup(data, path, AIR, "1 day", as_of=datetime(2024, 1, 5, 5))
    got = read_rollup(spark, path, AIR, since=datetime(2024, 1, 2), until=datetime(2024, 1, 3))
    assert rows(got, "no2_avg") == [(2.0,)]
    assert "PartitionFilters: [isnotnull(part" in got._jdf.queryExecution().executedPlan().toString()


# -- exports and the session


def test_export_writes_rows_and_metadata(spark, tmp_path):
    export_dataset(air_rows(spark, ("a", 0, 1.0, "x"), ("b", 0, 1.0, "x")), str(tmp_path), "vias", 5)
    meta = spark.read.json(str(tmp_path / "vias" / "metadata")).first()
    assert (meta.dataset_id, meta.total_records, meta.api_total_count) == ("vias", 2, 5)
    assert spark.read.json(str(tmp_path / "vias" / "full")).count() == 2


def test_topk_payload_keeps_order(spark):
    top = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "fiwareid string, distance_meters double")
    got = topk_payload(top, "trees", 39.0, -0.4, "name", "pin").first()
    assert (got.dataset_id, got["count"], [f.fiwareid for f in got.features]) == ("trees", 2, ["a", "b"])
    assert got.filter_pattern == "pin" and got.reference_point.lat == 39.0


def test_session_rules(spark):
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or work_dir(spark, "x").startswith(configured)
    assert not exists(spark, work_dir(spark, "x")) and list_names(spark, work_dir(spark, "x")) == []


def test_layouts_are_decided_file_by_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"fiwareid":"a"}\n{"fiwareid":"b"}\n')
    (tmp_path / "in" / "2.json").write_text('[\n{"fiwareid":"c"},\n{"fiwareid":"d"}\n]\n')
    (tmp_path / "in" / "3.json").write_text('\n{\n "fiwareid": "e"\n}')
    for strict in (True, False):
        got = S.read_json_or_ndjson(spark, str(tmp_path / "in"), AIR.raw_schema, strict=strict)
        assert sorted(r.fiwareid for r in got.collect()) == ["a", "b", "c", "d", "e"]


def test_records_of_equally_numbered_pages_are_told_apart(spark):
    pages = spark.createDataFrame([("a.json", '[{"fiwareid":"x"}]'), ("b.json", '[{"fiwareid":"y"}]')], "file string, value string")
    got, _ = S.parse_record_pages(pages, AIR.raw_schema)
    assert len({tuple(r._seq) for r in got.collect()}) == 2


@pytest.mark.parametrize("master, warehouse, refused", [
    ("local[4]", "file:/tmp/w", False), ("local", "/tmp/w", False), ("spark://host:7077", "file:/tmp/w", True), ("yarn", "/tmp/w", True),
    ("local-cluster[2,1,1024]", "file:/tmp/w", True), ("yarn", "hdfs://name/w", False),
])
def test_scratch_on_the_drivers_machine_is_refused_on_a_cluster(master, warehouse, refused):
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.sql.warehouse.dir": warehouse})
        sparkContext = type("Context", (), {"master": master})

    if refused:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session)
    else:
        assert shared_dir(Session) == warehouse
    Session.conf["spark.checkpoint.dir"] = "file:/shared"
    assert shared_dir(Session) == "file:/shared"
