"""The readings table: partitioned Parquet with last-write-wins upserts under a commit log.

    <path>/commits/0000000012.json                       the table after its 12th commit
    <path>/commits/latest                                a hint where the newest commit is
    <path>/data/commit=<name>/chunk_start=2024-01-01/…   rows of one commit, unique per key

A writer stores its rows first and then commits them by creating the next numbered file, which only one writer can do;
the loser reads the new state and tries again. That number orders the whole table, whoever writes: the later commit wins
per key. A batch is named by its writer and number and is committed once; running it again changes nothing. Each commit
file lists the live pieces of every chunk, so a reader opens one small file and lists no folder. A compaction replaces
exactly the pieces it read; commits that arrive meanwhile stay as they are. Stations are deleted by naming them in a commit:
readers leave out what was committed before, and compactions fold it away. Folders that are no longer needed stay for a time
of grace, so that open reads end well.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.time import chunk_start
from skyledger.operators.changes import dedup_batch
from skyledger.operators.filters import scan_range
from skyledger.operators.windows import last_row
from skyledger.session import literal_table, require_utc
from skyledger.sources.files import ages, create, exists, list_names, read_text, remove, replace_text
from skyledger.spec import DatasetSpec

CHUNK_DAYS = 7
#: How long folders stay that no commit names any more, and those that no commit has named yet.
GRACE, ABANDONED = timedelta(days=1), timedelta(days=7)


@dataclass
class State:
    """The table after a commit. ``chunks`` maps a day to its live pieces ``[commit name, order]``, ``batches`` a writer to
    the ranges of batch numbers it has committed, ``dropped`` lists folders that no reader of this state needs, with the time
    they were retired. ``deleted`` lists commits ``[commit name, order]`` that name deleted stations: pieces up to that order
    no longer hold them. ``policies`` are settings of the table, such as how many days it keeps."""

    version: int = 0
    chunks: dict[str, list[list]] = field(default_factory=dict)
    batches: dict[str, list[list[int]]] = field(default_factory=dict)
    dropped: list[list] = field(default_factory=list)
    deleted: list[list] = field(default_factory=list)
    policies: dict[str, int] = field(default_factory=dict)

    def retire(self, folders: Iterable[str]) -> None:
        self.dropped += [[f, time.time()] for f in folders]

    def tidy(self) -> None:
        self.chunks = {d: p for d, p in self.chunks.items() if p}

    def has(self, writer: str, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self.batches.get(writer, []))

    def note(self, writer: str, batch: int) -> None:
        joined: list[list[int]] = []
        for low, high in sorted([*self.batches.get(writer, []), [batch, batch]]):
            if joined and low <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], high)
            else:
                joined.append([low, high])
        self.batches[writer] = joined


class Committed:
    """A folder whose state is the newest of its numbered commit files."""

    kind: type = State

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def state(self):
        """The newest commit: found from the hint, and from there one by one."""
        while True:
            at = self._newest()
            text = read_text(self.spark, self._file(at)) if at else None
            if text or not at:
                return self.kind(**json.loads(text)) if text else self.kind()

    def _file(self, version: int) -> str:
        return f"{self.path}/commits/{version:010d}.json"

    def _newest(self) -> int:
        hint = read_text(self.spark, f"{self.path}/commits/latest")
        at = int(hint) if hint and hint.isdigit() else 0
        if not at or not exists(self.spark, self._file(at)):
            at = max([0, *[int(n[:-5]) for n in list_names(self.spark, f"{self.path}/commits") if n.endswith(".json")]])
        while exists(self.spark, self._file(at + 1)):
            at += 1
        return at

    def _commit(self, change: Callable[..., bool]) -> bool:
        """Apply a change to the newest state until it is committed, or it declines."""
        while True:
            state = self.state()
            if not change(state):
                return False
            state.tidy()
            state.version += 1
            if create(self.spark, self._file(state.version), json.dumps(asdict(state), sort_keys=True)):
                replace_text(self.spark, f"{self.path}/commits/latest", str(state.version))
                return True

    def _clear(self, named: Callable[..., set[str]], grace: timedelta, abandoned: timedelta) -> list[str]:
        """Remove folders that were retired before the time of grace, commit files older than that, and folders under ``data``
        that no commit names and nobody has changed for the time ``abandoned``."""
        gone: list[str] = []
        limit = time.time() - grace.total_seconds()

        def forget(state) -> bool:
            gone[:] = [f for f, at in state.dropped if at <= limit]
            state.dropped = [d for d in state.dropped if d[1] > limit]
            return bool(gone)

        self._commit(forget)
        # Changes first, the state after them: a folder that is committed in between is named by that state.
        changed = ages(self.spark, f"{self.path}/data")
        state = self.state()
        held = {f.split("/")[1] for f, _ in state.dropped} | {f"commit={n}" for n in named(state)}
        roots = {f.split("/")[1] for f in gone}
        lost = [f"data/{n}" for n, age in changed.items() if n not in held | roots and age >= abandoned.total_seconds()]
        for folder in [*gone, *lost]:
            remove(self.spark, f"{self.path}/{folder}")
        for root in sorted(roots - held):
            remove(self.spark, f"{self.path}/data/{root}")
        for old, age in ages(self.spark, f"{self.path}/commits").items():
            if old.endswith(".json") and int(old[:-5]) < state.version and age >= grace.total_seconds():
                remove(self.spark, f"{self.path}/commits/{old}")
        return [*gone, *lost]


class ReadingsTable(Committed):
    def __init__(self, spark: SparkSession, path: str, spec: DatasetSpec):
        require_utc(spark)
        super().__init__(spark, path)
        self.spec = spec

    @property
    def _row(self) -> list[str]:
        return [self.spec.key, self.spec.ts, *self.spec.values]

    @property
    def _stored(self) -> T.StructType:
        fields = [T.StructField(f.name, f.dataType) for f in self.spec.schema]
        return T.StructType(
            [*fields, T.StructField("_set", T.ArrayType(T.StringType())), T.StructField("commit", T.StringType()), T.StructField("chunk_start", T.DateType())]
        )

    # -- writing

    def upsert(
        self, batch: DataFrame, batch_id: int, cols: Sequence[str] | None = None, seq: str | Sequence[str] | None = None, writer: str = "batch"
    ) -> bool:
        """Write one batch; false if the writer has committed this batch before.

        The commit that comes later wins per key, NULLs included; ``cols`` names the only columns this statement sets, the
        others keep their value. Within the batch the last row by ``seq`` wins, without one the greatest by its values; a
        list of columns orders by each of them in turn. Rows without key or instant are not stored.
        """
        if self.state().has(writer, batch_id):
            return False
        spec = self.spec
        given = list(cols) if cols is not None else spec.values
        rows = batch.filter(F.col(spec.key).isNotNull() & F.col(spec.ts).isNotNull())
        if isinstance(seq, str):
            rows = last_row(rows, [spec.key, spec.ts], [seq], given)
        else:
            # Where the order holds every value, the greatest order is the row: nothing else is carried.
            order = [*(seq or []), *[c for c in given if c not in (seq or [])]]
            greatest = rows.groupBy(spec.key, spec.ts).agg(F.max(F.struct(*order)).alias("_row"))
            rows = greatest.select(spec.key, spec.ts, *[F.col("_row")[c].alias(c) for c in given])
        fields = {f.name: f.dataType for f in spec.schema}
        mark = F.array(*[F.lit(c) for c in given]) if cols is not None else F.lit(None)
        out = rows.select(
            spec.key,
            spec.ts,
            *[(F.col(c) if c in given else F.lit(None)).cast(fields[c]).alias(c) for c in spec.values],
            mark.cast("array<string>").alias("_set"),
            chunk_start(spec.ts).alias("chunk_start"),
        )
        name, days = self._store(out)

        def add(state: State) -> bool:
            if state.has(writer, batch_id):
                return False
            state.note(writer, batch_id)
            for day in days:
                state.chunks.setdefault(day, []).append([name, state.version + 1])
            return True

        done = self._commit(add)
        if not done:
            remove(self.spark, f"{self.path}/data/commit={name}")
        return done

    def delete(self, stations: DataFrame, batch_id: int, writer: str = "batch") -> bool:
        """Remove all rows of the stations in the frame's key column that were committed so far; false if this was done before.

        Rows that come later are stored as usual.
        """
        if self.state().has(writer, batch_id):
            return False
        name = uuid.uuid4().hex
        stations.select(self.spec.key).filter(F.col(self.spec.key).isNotNull()).distinct().write.parquet(f"{self.path}/{_stations(name)}")

        def add(state: State) -> bool:
            if state.has(writer, batch_id):
                return False
            state.note(writer, batch_id)
            state.deleted.append([name, state.version])
            return True

        done = self._commit(add)
        if not done:
            remove(self.spark, f"{self.path}/data/commit={name}")
        return done

    def rename(self, mapping: DataFrame, batch_id: int, writer: str = "batch") -> bool:
        """Move the rows of stations ``old_id`` to ``new_id``; false if this was done before.

        The moved rows are a commit like any other: where the station has a row of its own at an instant, the moved one
        wins, NULLs included, as it comes later. Where several move there, that of the greatest old id stays. All stations
        move at once, so names may change places. If another writer commits meanwhile, it is done again on top of that.
        """
        spec = self.spec
        names = mapping.select(F.col("old_id").alias("_old"), F.col("new_id").alias("_new")).filter("_old <> _new")
        names = names.groupBy("_old").agg(F.max("_new").alias("_new"))
        while True:
            state = self.state()
            if state.has(writer, batch_id):
                return False
            moved = self._current(state, state.chunks).join(names, F.col(spec.key) == F.col("_old"))
            rest = [spec.ts, *spec.values, "chunk_start"]
            renamed = moved.select(F.col("_new").alias(spec.key), *rest, "_old")
            settled = dedup_batch(renamed, [spec.key, spec.ts], "_old").withColumn("_set", F.lit(None).cast("array<string>"))
            name, days = self._store(settled.select(*self._row, "_set", "chunk_start"))
            names.select(F.col("_old").alias(spec.key)).write.parquet(f"{self.path}/{_stations(name)}")

            def add(now: State) -> bool:
                if now.version != state.version:
                    return False
                now.note(writer, batch_id)
                now.deleted.append([name, now.version])
                for day in days:
                    now.chunks.setdefault(day, []).append([name, now.version + 1])
                return True

            if self._commit(add):
                return True
            remove(self.spark, f"{self.path}/data/commit={name}")

    def set_policies(self, **policies: int) -> None:
        """Keep settings with the table, such as ``retention_days``; ``retention`` goes by them, and ``policy_checks`` compares them."""

        def change(state: State) -> bool:
            state.policies |= policies
            return True

        self._commit(change)

    def compact(self, before: date | None = None) -> list[date]:
        """Fold chunks of several pieces, or with deleted stations, that end by ``before`` (all when not given) into one piece each.

        Rows are stored by station, newest first, which suits both encodings and file statistics. Pieces committed while
        this runs are not folded; if another compaction was faster, nothing is changed.
        """
        limit = lambda day: before is None or _day(day) + timedelta(days=CHUNK_DAYS) <= before
        seen = self.state()
        known = max([0, *[order for _, order in seen.deleted]])
        due = lambda pieces: len(pieces) > 1 or any(order <= known for _, order in pieces)
        chosen = {day: pieces for day, pieces in seen.chunks.items() if due(pieces) and limit(day)}
        if not chosen:
            return []
        name, days = self._store(self._merged(seen, chosen), sort=True)

        def swap(state: State) -> bool:
            for day, pieces in chosen.items():
                live = state.chunks.get(day, [])
                if any(p not in live for p in pieces):
                    return False
                # The folded piece stands where the last of its pieces stood, or after the deletions it has carried out.
                folded = [[name, max([known + 1 if known else 0, *[order for _, order in pieces]])]] if day in days else []
                state.chunks[day] = sorted(folded + [p for p in live if p not in pieces], key=lambda p: p[1])
                state.retire(_folder(p[0], day) for p in pieces)
            oldest = min((order for pieces in state.chunks.values() for _, order in pieces), default=state.version + 1)
            state.retire(_stations(n) for n, order in state.deleted if order < oldest)
            state.deleted = [d for d in state.deleted if d[1] >= oldest]
            return True

        if not self._commit(swap):
            remove(self.spark, f"{self.path}/data/commit={name}")
            return []
        return sorted(_day(d) for d in chosen)

    def vacuum(self, grace: timedelta = GRACE, abandoned: timedelta = ABANDONED) -> list[str]:
        """Remove folders that were retired before the time of grace, commit files older than that, and folders of writers that
        died before their commit, which no commit names and nobody has changed for the time ``abandoned``."""
        return self._clear(lambda state: {n for pieces in state.chunks.values() for n, _ in pieces} | {n for n, _ in state.deleted}, grace, abandoned)

    def retention(self, as_of: datetime | None = None, days: int | None = None) -> list[date]:
        """Drop whole chunks whose range has fully aged out, by the table's policy ``retention_days`` where ``days`` is not given;
        their files go with the next ``vacuum`` after the time of grace."""
        if days is None:
            days = self.state().policies.get("retention_days", self.spec.retention_days)
        limit = _utc(as_of or datetime.now(timezone.utc)) - timedelta(days=days)
        gone: list[str] = []

        def drop(state: State) -> bool:
            gone[:] = [d for d in state.chunks if _midnight(_day(d)) + timedelta(days=CHUNK_DAYS) <= limit]
            for day in gone:
                state.retire(_folder(name, day) for name, _ in state.chunks.pop(day))
            return bool(gone)

        if self._commit(drop):
            self.vacuum()
        return sorted(_day(d) for d in gone)

    # -- reading

    def read(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The current rows, with ``chunk_start``; chunks outside the range are not even listed."""
        low, high = (None if v is None else _utc(v) for v in (since, until))
        return scan_range(
            self.read_chunks(
                lambda day: (low is None or _midnight(day) + timedelta(days=CHUNK_DAYS) > low) and (high is None or _midnight(day) < high)
            ),
            self.spec.ts, since, until,
        )

    def read_chunks(self, wanted: Callable[[date], bool]) -> DataFrame:
        """The current rows of the chunks whose first day is wanted, with ``chunk_start``."""
        state = self.state()
        return self._current(state, {day: pieces for day, pieces in state.chunks.items() if wanted(_day(day))})

    def chunks(self) -> list[date]:
        return sorted(_day(d) for d in self.state().chunks)

    # -- internals

    def _store(self, rows: DataFrame, sort: bool = False) -> tuple[str, list[str]]:
        """Write rows under a new name; returns it with the days that have rows."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/commit={name}"
        # Rebalancing keeps files few and splits a chunk that outgrows one task.
        placed = rows.hint("rebalance", "chunk_start")
        if sort:
            placed = placed.sortWithinPartitions("chunk_start", self.spec.key, F.desc(self.spec.ts))
        placed.write.mode("overwrite").partitionBy("chunk_start").parquet(folder)
        return name, [n.split("=")[1] for n in list_names(self.spark, folder) if n.startswith("chunk_start=")]

    def _load(self, chunks: dict[str, list[list]]) -> DataFrame:
        folders = [f"{self.path}/{_folder(name, day)}" for day, pieces in chunks.items() for name, _ in pieces]
        return self.spark.read.schema(self._stored).option("basePath", f"{self.path}/data").parquet(*folders)

    def _current(self, state: State, chunks: dict[str, list[list]]) -> DataFrame:
        cols = [*self._row, "chunk_start"]
        # A piece is unique per key, so a chunk of one piece needs no merge.
        single = {d: p for d, p in chunks.items() if len(p) == 1}
        several = {d: p for d, p in chunks.items() if len(p) > 1}
        alone = [(self._placed(state, single) if state.deleted else self._load(single)).select(*cols)] if single else []
        parts = alone + ([self._merged(state, several).select(*cols)] if several else [])
        if not parts:
            return self.spark.createDataFrame([], self._stored).select(*cols)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _placed(self, state: State, chunks: dict[str, list[list]]) -> DataFrame:
        """Stored rows with the order of their piece, without those of stations deleted after it."""
        # A folded piece takes an order of its own in each chunk.
        order = literal_table(self.spark, sorted((n, d, o) for d, pieces in chunks.items() for n, o in pieces), "commit string, day string, _order long")
        places = order.select("commit", F.col("day").cast("date").alias("chunk_start"), "_order")
        rows = self._load(chunks).join(places, ["commit", "chunk_start"])
        if not state.deleted:
            return rows
        key, dead = T.StructType([self.spec.schema[self.spec.key]]), None
        for name, last in state.deleted:
            part = self.spark.read.schema(key).parquet(f"{self.path}/{_stations(name)}").select(F.col(self.spec.key).alias("_gone"), F.lit(last).cast("long").alias("_last"))
            dead = part if dead is None else dead.unionByName(part)
        dead = dead.groupBy("_gone").agg(F.max("_last").alias("_last"))
        joined = rows.join(dead, F.col(self.spec.key) == F.col("_gone"), "left")
        return joined.filter(F.col("_last").isNull() | (F.col("_order") > F.col("_last"))).drop("_gone", "_last")

    def _merged(self, state: State, chunks: dict[str, list[list]]) -> DataFrame:
        """Per column, the value of the last commit that set it.

        A piece is unique per key, so a key has no more rows than its chunk has pieces: they are shuffled as they are and
        sorted once, as a partial aggregate would sort them all for nothing.
        """
        spec = self.spec
        marked = lambda c: F.when(F.col("_set").isNull() | F.array_contains("_set", c), F.col("_order"))
        placed = self._placed(state, chunks).repartition(spec.key, spec.ts)
        merged = placed.groupBy(spec.key, spec.ts, "chunk_start").agg(*[F.max_by(c, marked(c)).alias(c) for c in spec.values])
        return merged.withColumn("_set", F.lit(None).cast("array<string>"))


def _stations(name: str) -> str:
    return f"data/commit={name}/deleted"


def _folder(name: str, day: str) -> str:
    return f"data/commit={name}/chunk_start={day}"


def _day(text: str) -> date:
    return date.fromisoformat(text)


def _midnight(day: date) -> datetime:
    return datetime.combine(day, datetime.min.time())


def _utc(at: datetime) -> datetime:
    return at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at
