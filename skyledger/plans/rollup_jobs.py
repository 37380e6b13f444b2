"""Keeping stored rollups up to date."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.time import BUCKET_ORIGIN, before, interval_seconds
from skyledger.operators.filters import scan_range
from skyledger.operators.rollups import BUCKET_NAMES, finish_states, merge_states, rollup, rollup_states, state_schema
from skyledger.session import require_utc
from skyledger.sources.files import list_names, remove
from skyledger.sources.table import ABANDONED, CHUNK_DAYS, GRACE, Committed, ReadingsTable
from skyledger.spec import DatasetSpec

# How far back the weekly policy looks, and where both policies stop before now.
WEEKLY_REFRESH_DAYS, END_OFFSET_DAYS = 180, 1


def refresh_window(width: str, start_offset, end_offset, as_of: datetime) -> tuple[datetime, datetime]:
    """The span of whole buckets inside ``[as_of - start, as_of - end)``."""
    step = interval_seconds(width)
    origin = datetime.fromisoformat(BUCKET_ORIGIN)
    now = as_of.astimezone(timezone.utc).replace(tzinfo=None) if as_of.tzinfo else as_of
    low = (now - timedelta(seconds=interval_seconds(start_offset)) - origin).total_seconds()
    high = (now - timedelta(seconds=interval_seconds(end_offset)) - origin).total_seconds()
    first, last = -(-low // step) * step, high // step * step
    return origin + timedelta(seconds=first), origin + timedelta(seconds=last)


@dataclass
class RollupState:
    """A stored rollup after a commit. ``parts`` maps a bucket's start to its piece ``[commit name, version]``; ``mark`` is the
    version of the source that the buckets include; ``dropped`` lists retired folders with the time of that."""

    version: int = 0
    parts: dict[str, list] = field(default_factory=dict)
    mark: int = 0
    dropped: list[list] = field(default_factory=list)

    def tidy(self) -> None:
        """Nothing to do: a part without a piece is not kept."""


class RollupStore(Committed):
    """Buckets as mergeable states (``rollups.rollup_states``), a folder each, published together by one commit.

    A reader opens the folders that one commit names, so it sees all of a refresh or nothing; replaced folders stay for a
    time of grace.
    """

    kind = RollupState

    def __init__(self, spark: SparkSession, path: str, spec: DatasetSpec, width: str = "1 day"):
        require_utc(spark)
        super().__init__(spark, path)
        self.spec, self.width, self.bucket = spec, width, BUCKET_NAMES.get(width, "bucket")

    def replace(self, states: DataFrame, old: Callable[[str], bool], mark: int | None = None) -> bool:
        """Put states in the place of all buckets for which ``old`` holds; declined if the store has seen a later ``mark``."""
        name = uuid.uuid4().hex
        placed = states.withColumn("part", F.date_format(self.bucket, PART)).hint("rebalance", "part")
        placed.write.partitionBy("part").parquet(f"{self.path}/data/commit={name}")
        fresh = [n[5:] for n in list_names(self.spark, f"{self.path}/data/commit={name}") if n.startswith("part=")]

        def swap(state: RollupState) -> bool:
            if mark is not None and state.mark > mark:
                return False
            gone = [p for p in state.parts if old(p) or p in fresh]
            state.dropped += [[_piece(state.parts.pop(p)[0], p), time.time()] for p in gone]
            state.parts |= {p: [name, state.version + 1] for p in fresh}
            state.mark = state.mark if mark is None else mark
            return True

        done = self._commit(swap)
        if not done or not fresh:
            remove(self.spark, f"{self.path}/data/commit={name}")
        return done

    def states(self, wanted: Callable[[str], bool] = lambda part: True, state: RollupState | None = None) -> DataFrame:
        """Stored states of the buckets whose start, as text, is wanted, with that text as ``part``."""
        state, text = state or self.state(), T.StringType()
        schema = T.StructType([*state_schema(self.spec, self.bucket), T.StructField("commit", text), T.StructField("part", text)])
        folders = [f"{self.path}/{_piece(name, part)}" for part, (name, _) in sorted(state.parts.items()) if wanted(part)]
        if not folders:
            return self.spark.createDataFrame([], schema).drop("commit")
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).drop("commit")

    def vacuum(self, grace: timedelta = GRACE, abandoned: timedelta = ABANDONED) -> list[str]:
        """As for the readings table."""
        return self._clear(lambda state: {name for name, _ in state.parts.values()}, grace, abandoned)


PART = "yyyyMMddHHmmss"


def _piece(name: str, part: str) -> str:
    return f"data/commit={name}/part={part}"


def refresh_rollup(
    readings: DataFrame,
    path: str,
    spec: DatasetSpec,
    width: str = "1 day",
    start_offset: str | None = None,
    end_offset: str = "1 day",
    as_of: datetime | None = None,
) -> tuple[datetime, datetime]:
    """Recompute the whole buckets of the refresh window and replace exactly those on disk.

    Only readings of the window are scanned, once. Buckets outside it stay as they are, so history loaded later
    needs a call with a longer ``start_offset``. A bucket whose readings are all gone goes, too.
    """
    start_offset = start_offset or f"{spec.daily_refresh_days if width == '1 day' else WEEKLY_REFRESH_DAYS} days"
    low, high = refresh_window(width, start_offset, end_offset, as_of or datetime.now(timezone.utc))
    if low < high:
        fresh = rollup_states(scan_range(readings, spec.ts, low, high), spec, width)
        RollupStore(readings.sparkSession, path, spec, width).replace(fresh, lambda part: _part(low) <= part < _part(high))
    return low, high


def refresh_touched(table: ReadingsTable, path: str, width: str = "1 day") -> list[date]:
    """Recompute the buckets of those chunks that have commits since the last call, and of no others.

    The mark is the table's version before the refresh and part of the same commit, so a refresh that is cut short is made
    again, and one that was overtaken changes nothing. A compaction alone touches nothing; a deletion of stations touches
    every chunk that may hold them. Bucket widths must divide a chunk.
    """
    if CHUNK_DAYS * 86400 % interval_seconds(width):
        raise ValueError(f"buckets of {width} don't divide a chunk of {CHUNK_DAYS} days")
    store, state = RollupStore(table.spark, path, table.spec, width), table.state()
    mark = store.state().mark
    # A deletion of order n was committed as version n + 1.
    deleted = max([0, *[order for _, order in state.deleted if order + 1 > mark]])
    touched = lambda pieces: max(o for _, o in pieces) > mark or min(o for _, o in pieces) <= deleted
    days = sorted(date.fromisoformat(d) for d, pieces in state.chunks.items() if touched(pieces))
    if not days:
        return []
    fresh = rollup_states(table.read_chunks(lambda day: day in days), table.spec, width)
    spans = [(_part(s), _part(s + timedelta(days=CHUNK_DAYS))) for s in (datetime.combine(d, datetime.min.time()) for d in days)]
    store.replace(fresh, lambda part: any(low <= part < high for low, high in spans), state.version)
    return days


def refresh_from(narrow: RollupStore, wide: RollupStore) -> list[str]:
    """Merge stored buckets into wider ones, such as weeks from days, without any readings: only buckets that got new pieces
    since the last call are made again. Returns their starts."""
    if interval_seconds(wide.width) % interval_seconds(narrow.width):
        raise ValueError(f"buckets of {narrow.width} don't divide {wide.width}")
    step, origin = interval_seconds(wide.width), datetime.fromisoformat(BUCKET_ORIGIN)

    def of(part: str) -> str:
        since = (datetime.strptime(part, "%Y%m%d%H%M%S") - origin).total_seconds()
        return _part(origin + timedelta(seconds=since // step * step))

    now, before = narrow.state(), wide.state()
    touched = {of(part) for part, (_, version) in now.parts.items() if version > before.mark}
    # Buckets that lost their last piece.
    touched |= set(before.parts) - {of(part) for part in now.parts}
    if touched:
        states = narrow.states(lambda part: of(part) in touched, now)
        wide.replace(merge_states(states, wide.spec, narrow.bucket, wide.width), lambda part: part in touched, now.version)
    return sorted(touched)


def read_rollup(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    width: str = "1 day",
    readings: DataFrame | None = None,
    realtime: bool = False,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Stored buckets that start in ``[since, until)``; in real-time mode also fresh ones after the newest stored bucket.

    Bounds prune folders, as a bucket's folder is named by its start. All buckets are those of one commit, whatever is
    refreshed until they are read.
    """
    store = RollupStore(spark, path, spec, width)
    state = store.state()
    inside = lambda part: (since is None or part >= _part(since)) and (until is None or part < _part(until))
    states = store.states(inside, state)
    if since is not None:
        states = states.filter(F.col("part") >= _part(since))
    if until is not None:
        states = states.filter(F.col("part") < _part(until))
    stored = finish_states(states, spec, store.bucket)
    if not realtime:
        return stored
    readings = scan_range(readings, spec.ts, since, until)
    if state.parts:
        end = datetime.strptime(max(state.parts), "%Y%m%d%H%M%S") + timedelta(seconds=interval_seconds(width))
        readings = scan_range(readings, spec.ts, end, None)
    return stored.unionByName(rollup(readings, spec, width))


def _part(at: datetime) -> str:
    at = at.astimezone(timezone.utc) if at.tzinfo else at
    return f"{at:%Y%m%d%H%M%S}"


def stored_checks(stored: dict[str, DataFrame], expected: dict[str, list[str]], ts: dict[str, str], kept_days: dict[str, int], as_of) -> DataFrame:
    """Per stored table, from its rows: the columns it lacks, how many rows it has, and how many have outlived the
    table's retention (none are counted where no retention is given)."""
    out = None
    for name, df in stored.items():
        days = kept_days.get(name)
        late = F.lit(False) if days is None else F.col(ts[name]) < before(as_of, days * 86400)
        lacking = F.lit(",".join(c for c in expected[name] if c not in df.columns))
        row = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("overdue")).select(
            F.lit(name).alias("table_name"), "rows", lacking.alias("missing"), "overdue"
        )
        out = row if out is None else out.unionByName(row)
    return out


def policy_checks(tables: dict[str, ReadingsTable], expected: dict[str, dict[str, int]]) -> DataFrame:
    """Per table and expected policy: the setting that the table keeps, and whether it is as expected."""
    rows = []
    for name, policies in sorted(expected.items()):
        kept = tables[name].state().policies | {"chunk_days": CHUNK_DAYS}
        rows += [(name, policy, want, kept.get(policy), kept.get(policy) == want) for policy, want in sorted(policies.items())]
    spark = next(iter(tables.values())).spark
    return spark.createDataFrame(rows, "table_name string, policy string, expected long, kept long, as_expected boolean")


def table_checks(spark: SparkSession, expected: dict[str, list[str]]) -> DataFrame:
    """Per expected table: whether it exists in the catalog and which columns it lacks."""
    rows = []
    for name, columns in expected.items():
        found = spark.catalog.tableExists(name)
        have = set(spark.table(name).columns) if found else set()
        rows.append((name, found, [c for c in columns if c not in have]))
    return spark.createDataFrame(rows, "table_name string, present boolean, missing_columns array<string>")


def assert_tables(spark: SparkSession, expected: dict[str, list[str]]) -> None:
    bad = table_checks(spark, expected).filter(~F.col("present") | (F.size("missing_columns") > 0)).collect()
    if bad:
        raise ValueError("missing tables or columns: " + "; ".join(f"{r.table_name} {r.missing_columns}" for r in bad))
