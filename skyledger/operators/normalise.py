"""Raw portal records to canonical readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.fingerprint import value_fingerprint
from skyledger.functions.geo import extract_lat_lon
from skyledger.functions.once import spread
from skyledger.functions.time import format_ts, normalise_ts
from skyledger.spec import DatasetSpec

# Timestamp column names tried in order.
TS_CANDIDATES = [
    "fecha_carg",
    "update_jcd",
    "timestamp",
    "fechahora",
    "fecha",
    "updated_at",
    "date",
    "data",
    "last_update",
]


def station_id(fiwareid: Column, objectid: Column) -> Column:
    """The station id, or ``obj<objectid>``, or ``objna`` when both are missing, empty or zero."""
    number = F.nullif(objectid.cast("string"), F.lit("0"))
    return F.coalesce(F.nullif(fiwareid, F.lit("")), F.concat(F.lit("obj"), F.coalesce(number, F.lit("na"))))


def normalise(raw: DataFrame, spec: DatasetSpec, ts_col: str | None = None) -> DataFrame:
    """Canonical event columns plus the fingerprint ``_fp``; one projection, no shuffle.

    Fields the snapshot does not carry become NULL. The instant is ISO text, as on the wire.
    """
    have = set(raw.columns)
    types = {f.name: f.dataType for f in raw.schema.fields}

    def pick(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    kind = "wkt" if types.get("geo_point_2d") == T.StringType() else "struct"
    lat, lon = (
        extract_lat_lon("geo_point_2d", kind)
        if "geo_point_2d" in have
        else (F.lit(None).cast("double"), F.lit(None).cast("double"))
    )
    source = ts_col or spec.ts_source
    instant = normalise_ts(source) if source in have else F.lit(None).cast("string")
    # Later steps filter on the instant several times; it is parsed once.
    body = spread(raw, F.struct(instant.alias("_instant"))).select(
        station_id(pick("fiwareid", "string"), pick("objectid", "long")).alias(spec.key),
        F.col("_instant").alias(spec.ts),
        *[
            pick(name, "string" if out in spec.texts else "double").alias(out)
            for name, out in spec.renames.items()
        ],
        lat.alias("lat"),
        lon.alias("lon"),
        *[c for c in raw.columns if c.startswith("_")],
    )
    return body.withColumn("_fp", value_fingerprint(spec.change_cols))


def project_available(df: DataFrame, desired: Sequence[str], ts_col: str) -> DataFrame:
    """The desired columns that exist, in the desired order, with the timestamp column at the end if absent."""
    have = [c for c in desired if c in df.columns]
    return df.select(*have, *([] if ts_col in have else [ts_col]))


def choose_ts_column(df: DataFrame, configured: str, auto: bool = True, typed: bool = False) -> str | None:
    """Configured name, then known names, then the first text column whose sample row looks like an instant.

    ``typed`` prefers the first date or timestamp column of the schema to the known names.
    """
    if configured in df.columns or not auto:
        return configured
    if typed:
        for f in df.schema.fields:
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                return f.name
    for name in TS_CANDIDATES:
        if name in df.columns:
            return name
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    sample = df.select(*texts).head(1) if texts else []
    for name in texts if sample else []:
        value = sample[0][name]
        if value and "T" in value and ":" in value:
            return name
    return None


def to_keyed_events(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """``key`` and JSON ``value`` per event; rows without an instant and internal columns are left out."""
    if isinstance(df.schema[spec.ts].dataType, T.StringType):
        ready = df.filter(F.col(spec.ts) != "")
    else:
        ready = df.filter(F.col(spec.ts).isNotNull()).withColumn(spec.ts, format_ts(spec.ts))
    body = [c for c in spec.columns if c in df.columns]
    return ready.select(
        F.concat_ws("|", spec.key, spec.ts).alias("key"),
        F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("value"),
    )


def from_keyed_events(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Typed readings from JSON event values."""
    keep = [c for c in df.columns if c not in ("key", "value")]
    body = F.from_json(F.col("value").cast("string"), spec.event_schema)
    typed = spread(df.select(*keep, "value"), body)
    return typed.select(
        *[F.try_to_timestamp(c).alias(c) if c == spec.ts else F.col(c) for c in spec.columns], *keep
    )

