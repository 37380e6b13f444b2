"""Instants: bucketing, parsing and rendering, all in UTC."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket origin (a Monday), the wire format, and the accepted range-bound formats.
BUCKET_ORIGIN = "2000-01-03"
WIRE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
BOUND_FORMATS = ["yyyy-M-d", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s'Z'", "yyyy-M-d H:m:s"]

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}

# One ISO-8601 instant, a zone only after a time of day; group 1 is the part before the zone.
ISO_INSTANT = r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?|$))(?:Z|[+-]\d{2}:?\d{2})?$"
NO_SECONDS = r"([T ]\d{2}:\d{2})(?=Z|[+-]|$)"


def interval_seconds(width: int | str | timedelta) -> int:
    """Length of a fixed interval such as ``'7 days'``, ``3600`` or a timedelta."""
    if isinstance(width, timedelta):
        return int(width.total_seconds())
    if isinstance(width, int):
        return width
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not found or found.group(2) not in UNIT_SECONDS:
        raise ValueError(f"not a fixed-length interval: {width!r}")
    return int(found.group(1)) * UNIT_SECONDS[found.group(2)]


def as_instant(value: Column | datetime | str | None) -> Column:
    """A timestamp column from a column, datetime or ISO text; ``None`` means now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    if isinstance(value, (datetime, date)):
        value = value.isoformat()
    return F.lit(value).cast("timestamp")


def before(as_of: Column | DataFrame | datetime | str | None, duration: int | str | timedelta) -> Column:
    """``as_of - duration``.

    A one-row, one-column DataFrame gives a scalar subquery that holds the finished bound, so that the
    comparison reaches the file scan as a plain filter.
    """
    step = F.expr(f"INTERVAL {interval_seconds(duration)} SECONDS")
    if isinstance(as_of, DataFrame):
        return as_of.select(F.col(as_of.columns[0]) - step).scalar()
    return as_instant(as_of) - step


def instant(as_of: Column | DataFrame | datetime | str | None) -> Column:
    return as_of.scalar() if isinstance(as_of, DataFrame) else as_instant(as_of)


def time_bucket(width: int | str | timedelta, ts: Column | str, origin: str = BUCKET_ORIGIN) -> Column:
    """Start of the fixed-width bucket that holds ``ts``; 7-day buckets start on Mondays."""
    seconds = interval_seconds(width)
    anchor = int(datetime.fromisoformat(origin).replace(tzinfo=timezone.utc).timestamp())
    at = F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)
    return F.timestamp_seconds(at - F.pmod(at - F.lit(anchor), F.lit(seconds)))


def chunk_start(ts: Column | str) -> Column:
    """The 7-day storage chunk, as a date."""
    return time_bucket("7 days", ts).cast("date")


def parse_instant(text: Column | str, group: int = 0) -> Column:
    """The timestamp a text spells in ISO-8601, else NULL; group 1 leaves the zone out.

    The input appears once in the expression, so a computed text is not computed again for its check.
    """
    found = F.replace(F.regexp_extract(text, ISO_INSTANT, group), F.lit(","), F.lit("."))
    return F.try_to_timestamp(F.regexp_replace(found, NO_SECONDS, "$1:00"))


def normalise_ts(text: Column | str) -> Column:
    """ISO-8601 text to ``YYYY-MM-DDTHH:MM:SSZ``; anything else gives NULL."""
    return format_ts(parse_instant(text))


def format_ts(ts: Column | str) -> Column:
    return F.date_format(ts, WIRE_FORMAT)


def combine_date_time(day: Column | str, time: Column | str) -> Column:
    """History date and optional time; a zone in the text is replaced by UTC, not converted."""
    day = F.col(day) if isinstance(day, str) else day
    time = F.col(time) if isinstance(time, str) else time
    tail = F.when(time != "", F.concat(F.lit("T"), time)).otherwise(F.lit(""))
    return parse_instant(F.concat(day, tail), group=1)


def parse_datetime_any(text: Column | str, strict: bool = True) -> Column:
    """A range bound in one of the accepted formats; strict mode fails on any other text."""
    col = F.col(text) if isinstance(text, str) else text
    parsed = F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in BOUND_FORMATS])
    if not strict:
        return parsed
    complaint = F.raise_error(F.concat(F.lit("Cannot parse datetime: "), col)).cast("timestamp")
    return F.when(col.isNull() | parsed.isNotNull(), parsed).otherwise(complaint)
