"""Every registered query against its SQL on the smallest tables, and the plans that matter at scale."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from skyledger.operators import geo as G
from skyledger.operators import joins as J
from skyledger.operators import rollups as U
from skyledger.operators import windows as W
from skyledger.operators.filters import last_interval, scan_range
from skyledger.registry import QUERIES
from skyledger.registry.core import as_of, events, readings
from skyledger.spec import AIR, WEATHER
from skyledger.stations import historical_names

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    query = QUERIES[name]
    frame = query.build(spark, SF_DIR)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    if query.sql is not None:
        result = duck.execute(query.sql)
        assert got == canonical([d[0] for d in result.description], result.fetchall())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds_and_columns_reach_the_scan(spark):
    text = plan(scan_range(readings(spark, SF_DIR), "ts", "2024-01-08", "2024-01-09").select("no2"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp,event_type:string,value:double>" in text


def test_rollup_is_one_shuffle_of_partial_aggregates(spark):
    text = plan(U.rollup(readings(spark, SF_DIR), WEATHER, "1 day"))
    assert text.count("Exchange") == 1 and "partial_avg" in text and "SortAggregate" not in text


def test_latest_rows_are_hash_aggregated(spark):
    text = plan(W.latest_per_station(readings(spark, SF_DIR), cols=["no2", "pm25"]))
    assert "SortAggregate" not in text and "partial_max_by" in text


def test_fixed_lookups_are_broadcast(spark):
    history = events(spark, SF_DIR).withColumn("estacion", F.col("event_type"))
    mapped, unmatched = J.map_station_ids(history, historical_names(spark, "air"))
    for df in (mapped, unmatched):
        assert "BroadcastHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)


def test_top_k_does_not_sort_everything(spark):
    stations = readings(spark, SF_DIR).select("fiwareid", "lat", "lon")
    assert "TakeOrderedAndProject" in plan(G.k_nearest(stations, 39.49, -0.4, 5))


def test_no_query_runs_python_or_cross_joins(spark):
    for name in ("climatology", "station_advances", "counter_increase", "station_coord_match", "emit_changes",
                 "validate_errors", "normalise_air", "tick_gaps", "alert_sustained", "stations_within_3km"):
        text = plan(QUERIES[name].build(spark, SF_DIR))
        for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, f"{bad} in {name}"


def test_windows_always_have_a_key(spark):
    for name in ("tick_gaps", "alert_sustained", "counter_increase"):
        text = plan(QUERIES[name].build(spark, SF_DIR))
        assert "Exchange SinglePartition" not in text, name


def ran(df):
    """The plan as it ran, without what adaptive execution replaced."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name, single", [("station_advances", 1), ("counter_increase", 0), ("counter_rate", 0), ("tick_gaps", 0), ("alert_sustained", 0)])
def test_segmented_scans_read_their_input_once_or_twice(spark, name, single):
    """Only station_advances carries something across all stations: one row per block of polls."""
    text = ran(QUERIES[name].build(spark, SF_DIR))
    assert text.count("FileScan") <= 2 and text.count("Exchange SinglePartition") <= single


def test_recent_bound_is_a_scalar_filter(spark):
    recent = last_interval(readings(spark, SF_DIR), "ts", "24 hours", as_of(spark, SF_DIR))
    text = plan(recent.select("no2"))
    assert "Subquery" in text and "Join" not in text


def test_air_columns_match_the_wire(spark):
    assert AIR.columns == [f.name for f in AIR.schema] == [f.name for f in AIR.event_schema]


def test_landed_lines_take_more_files_with_more_rows(spark, monkeypatch):
    monkeypatch.setattr("skyledger.registry.ingest.FILE_ROWS", 100, raising=False)
    rows = events(spark, SF_DIR).count()
    assert len(QUERIES["json_lines_cut"].build(spark, SF_DIR).inputFiles()) == -(-rows // 100) > 3


@pytest.mark.parametrize("broken", [False, True])
def test_entry_stands_alone(tmp_path, broken):
    """Without the training-text folders, or where they can't be imported, every other query is still there."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    left_out = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", "tests", "llm", *([] if broken else ["corpus_pipeline.py"]))
    copy = shutil.copytree(root, tmp_path / "copy", ignore=left_out)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(QUERIES)), str(sum(q.sql is not None for q in QUERIES.values()))]
