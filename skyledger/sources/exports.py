"""Dataset dumps and top-k payloads as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def export_dataset(df: DataFrame, path: str, dataset_id: str, api_total: int | None = None) -> None:
    """Dump all rows as JSON lines under ``<path>/full`` with one row of metadata under ``<path>/metadata``."""
    spark = df.sparkSession
    counted = Observation("export")
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").json(f"{path}/{dataset_id}/full")
    spark.range(1).select(
        F.lit(dataset_id).alias("dataset_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("download_timestamp"),
        F.lit(counted.get["rows"]).cast("long").alias("total_records"),
        F.lit(api_total).cast("long").alias("api_total_count"),
    ).coalesce(1).write.mode("overwrite").json(f"{path}/{dataset_id}/metadata")


def topk_payload(
    top: DataFrame, dataset_id: str, lat: float, lon: float, field: str | None = None, pattern: str | None = None
) -> DataFrame:
    """One row that wraps an already limited top-k result."""
    ranked = F.transform(
        F.array_sort(F.collect_list(F.struct("distance_meters", F.struct(*top.columns).alias("feature")))),
        lambda r: r["feature"],
    )
    return top.agg(ranked.alias("features")).select(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(field).cast("string").alias("filter_field"),
        F.lit(pattern).cast("string").alias("filter_pattern"),
        F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon")).alias("reference_point"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at_utc"),
        F.size("features").alias("count"),
        "features",
    )


def write_topk_payload(top: DataFrame, path: str, dataset_id: str, lat: float, lon: float, **filters) -> None:
    topk_payload(top, dataset_id, lat, lon, **filters).write.mode("overwrite").json(path)
