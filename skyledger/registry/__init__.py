"""Registered queries: each Spark query next to the SQL that restates it for a check."""

from skyledger.registry import ingest, lookups, series, tables  # noqa: F401
from skyledger.registry.core import QUERIES

__all__ = ["QUERIES"]
