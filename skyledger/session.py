"""Session set-up and the shared folder that jobs may write scratch tables to."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Names the scratch folders of this process.
RUN = uuid.uuid4().hex
_roots: set[str] = set()


def build_session(app: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; partition counts are left to the cluster and AQE."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Buckets, date parts and rendered timestamps are all defined in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone!r}")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, or the warehouse where that is not set.

    Executors of a cluster don't see a folder of the driver's machine, so a warehouse there is refused unless Spark runs locally.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = re.match(r"local(\[|$)", spark.sparkContext.master)
    if not local and re.match(r"file:|/", warehouse):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder: the warehouse {warehouse!r} is on the driver's machine")
    return warehouse


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name for tables and streaming checkpoints of this run; the run's folders go when it ends."""
    root = f"{shared_dir(spark)}/skyledger/{RUN}"
    if root not in _roots:
        _roots.add(root)
        atexit.register(_remove, spark, root, spark._jsc.hadoopConfiguration())
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, root: str, configuration) -> None:
    """The session's own configuration knows how to reach the store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    where.getFileSystem(configuration).delete(where, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame from a scratch table it is written to, so that several reads of it don't repeat its work."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of rows that are part of the plan, so that Spark knows their size and can pick a broadcast."""
    fields = [f.split() for f in schema.split(",")]
    columns = {name: [row[i] for row in rows] for i, (name, _) in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns)).select(*[F.col(n).cast(kind).alias(n) for n, kind in fields])
