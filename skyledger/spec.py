"""Dataset descriptions: one spec drives every operator for a kind of reading."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

D, S, TS = T.DoubleType(), T.StringType(), T.TimestampType()


@dataclass(frozen=True)
class DatasetSpec:
    """Names and rules of one dataset.

    ``renames`` maps raw portal fields to canonical columns, ``history`` maps history-CSV headers to them,
    and ``rollup`` lists ``(output, kind, input)`` with kind one of ``avg``, ``max``, ``circular``.
    """

    name: str
    metrics: tuple[str, ...]
    renames: dict[str, str]
    history: dict[str, str]
    rollup: tuple[tuple[str, str, str], ...]
    texts: tuple[str, ...] = ()
    required_history: str | None = None
    retention_days: int = 365
    daily_refresh_days: int = 30
    key: str = "fiwareid"
    ts: str = "ts"
    ts_source: str = "fecha_carg"
    places: tuple[str, ...] = field(default=("lat", "lon"))

    @property
    def change_cols(self) -> tuple[str, ...]:
        return self.metrics

    @property
    def values(self) -> list[str]:
        """Every column outside the primary key, in table order."""
        return [*self.metrics, *self.texts, *self.places]

    @property
    def columns(self) -> list[str]:
        return [self.key, self.ts, *self.values]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(self.key, S, False), T.StructField(self.ts, TS, False)]
            + [T.StructField(c, S if c in self.texts else D) for c in self.values]
        )

    @property
    def event_schema(self) -> T.StructType:
        """The JSON value of an event: the instant is an ISO string."""
        return T.StructType([T.StructField(f.name, S if f.name == self.ts else f.dataType) for f in self.schema])

    @property
    def raw_schema(self) -> T.StructType:
        """A raw portal record; ``geo_point_2d`` arrives as an object or, rarely, as WKT text."""
        point = T.StructType([T.StructField("lon", D), T.StructField("lat", D)])
        shape = T.StructType(
            [
                T.StructField("type", S),
                T.StructField(
                    "geometry",
                    T.StructType([T.StructField("coordinates", T.ArrayType(D)), T.StructField("type", S)]),
                ),
            ]
        )
        text = set(self.texts)
        return T.StructType(
            [
                T.StructField("objectid", T.LongType()),
                T.StructField("nombre", S),
                T.StructField("direccion", S),
                T.StructField("fiwareid", S),
                T.StructField(self.ts_source, S),
            ]
            + [T.StructField(raw, S if out in text else D) for raw, out in self.renames.items()]
            + [T.StructField("geo_point_2d", point), T.StructField("geo_shape", shape)]
        )


# Portal field names, history-file headers, rollup columns and policy lengths.
AIR = DatasetSpec(
    name="air",
    metrics=("no2", "o3", "so2", "co", "pm10", "pm25"),
    texts=("air_quality_summary",),
    renames={
        "so2": "so2",
        "no2": "no2",
        "o3": "o3",
        "co": "co",
        "pm10": "pm10",
        "pm25": "pm25",
        "calidad_am": "air_quality_summary",
    },
    history={"no2": "no2", "o3": "o3", "so2": "so2", "co": "co", "pm10": "pm10", "pm2_5": "pm25"},
    rollup=(
        ("co_avg", "avg", "co"),
        ("no2_avg", "avg", "no2"),
        ("o3_avg", "avg", "o3"),
        ("pm10_avg", "avg", "pm10"),
        ("pm25_avg", "avg", "pm25"),
        ("so2_avg", "avg", "so2"),
    ),
    retention_days=6000,
    daily_refresh_days=30,
)

WEATHER = DatasetSpec(
    name="weather",
    metrics=("wind_dir_deg", "wind_speed_ms", "temperature_c", "humidity_pct", "pressure_hpa", "precip_mm"),
    renames={
        "viento_dir": "wind_dir_deg",
        "viento_vel": "wind_speed_ms",
        "temperatur": "temperature_c",
        "humedad_re": "humidity_pct",
        "presion_ba": "pressure_hpa",
        "precipitac": "precip_mm",
    },
    history={
        "direccion_del_viento": "wind_dir_deg",
        "velocidad_del_viento": "wind_speed_ms",
        "temperatura": "temperature_c",
        "humedad_relativa": "humidity_pct",
        "presion": "pressure_hpa",
        "precipitacion": "precip_mm",
    },
    rollup=(
        ("temp_avg_c", "avg", "temperature_c"),
        ("humidity_avg", "avg", "humidity_pct"),
        ("pressure_avg", "avg", "pressure_hpa"),
        ("precip_max_mm", "max", "precip_mm"),
        ("wind_avg_deg", "circular", "wind_dir_deg"),
        ("wind_avg_ms", "avg", "wind_speed_ms"),
    ),
    required_history="temperature_c",
    retention_days=365,
    daily_refresh_days=60,
)

SPECS = {spec.name: spec for spec in (AIR, WEATHER)}
