"""Keeping a costly expression from being copied.

The optimiser inlines a projected expression into every place that reads a field of it, and copies it again
when a filter moves below the projection. Parsing is too dear for that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spread(df: DataFrame, struct: Column) -> DataFrame:
    """The frame with the struct's fields as further columns, the struct computed once per row."""
    return df.select("*", F.inline(F.array(struct)))
