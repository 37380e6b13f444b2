"""Value fingerprints for change detection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_fingerprint(columns: Iterable[str]) -> Column:
    """SHA-1 of the compact JSON of the metric values in name order, NULLs included."""
    body = F.struct(*[F.col(c).cast("double").alias(c) for c in sorted(columns)])
    # Never NULL, and known to the optimiser as such, so later checks for a missing fingerprint cost nothing.
    return F.coalesce(F.sha1(F.to_json(body, {"ignoreNullFields": "false"})), F.lit(""))
