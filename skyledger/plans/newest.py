"""Newest rows of the stored table without reading all of it: chunks are walked from the newest backwards.

Each step takes twice as many chunks as the one before and stops as soon as nothing older can matter, so a table whose stations
all report is read in its newest chunk only, and one silent station costs the chunks back to its last row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.windows import latest_per_station
from skyledger.session import work_dir
from skyledger.sources.table import ReadingsTable


def backwards(table: ReadingsTable) -> Iterator[list[date]]:
    """The table's chunks, newest first, in groups of 1, 2, 4 and so on."""
    left, size = table.chunks()[::-1], 1
    while left:
        yield left[:size]
        left, size = left[size:], 2 * size


def latest_stored(table: ReadingsTable, stations: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The newest row of each of ``stations``, a frame with the key column; those without any row are left out.

    Only the number of stations still missing reaches the driver; rows found so far are kept as a scratch table.
    """
    spec, spark = table.spec, table.spark
    wanted = [c for c in (cols or spec.values) if c not in (spec.key, spec.ts)]
    missing = stations.select(spec.key).filter(F.col(spec.key).isNotNull()).distinct()
    folder, schema = work_dir(spark, "latest"), None
    for step, days in enumerate(backwards(table)):
        rows = table.read_chunks(lambda day: day in days).select(spec.key, spec.ts, *wanted)  # noqa: B023
        found = latest_per_station(rows.join(missing, spec.key, "left_semi"), spec.key, spec.ts, wanted)
        schema = found.schema
        found.write.parquet(f"{folder}/step={step}")
        known = spark.read.schema(schema).parquet(folder)
        missing = stations.select(spec.key).filter(F.col(spec.key).isNotNull()).distinct().join(known.select(spec.key), spec.key, "left_anti")
        if missing.isEmpty():
            break
    if schema is None:
        return table.read().select(spec.key, spec.ts, *wanted)
    return spark.read.schema(schema).parquet(folder).select(spec.key, spec.ts, *wanted)


def newest_rows(table: ReadingsTable, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows, ties by key and then by ``order``; older chunks are read only if the newer ones hold fewer rows."""
    spec, days = table.spec, []
    for group in backwards(table):
        days += group
        if table.read_chunks(lambda day: day in days).limit(n).count() >= n:
            break
    rows = table.read_chunks(lambda day: day in days)
    return rows.drop("chunk_start").orderBy(F.desc(spec.ts), spec.key, *order).limit(n)


def newest_instant(table: ReadingsTable):
    """The newest instant of the table, or None; chunks that deletions have emptied are passed over."""
    for group in backwards(table):
        found = table.read_chunks(lambda day: day in group).agg(F.max(table.spec.ts)).first()[0]  # noqa: B023
        if found is not None:
            return found
    return None
