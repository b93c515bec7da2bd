"""Time expressions over epoch milliseconds and timestamps (F1-F8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
SECONDS_LIMIT = 10_000_000_000


def event_time(ms: Column) -> Column:
    """epoch milliseconds to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.call_function("div", ms.cast("bigint"), F.lit(1000)))


def date_id(ms: Column) -> Column:
    """epoch seconds of the start of the day."""
    return F.unix_timestamp(F.date_trunc("day", event_time(ms)))


def day_text(ts: Column) -> Column:
    """``yyyy-MM-dd`` text of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd")


def millis_text(ms: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """formatted text of epoch milliseconds."""
    return F.date_format(F.timestamp_millis(ms), pattern)


def millis_day(ms: Column) -> Column:
    """``yyyy-MM-dd`` text of epoch milliseconds."""
    return millis_text(ms, "yyyy-MM-dd")


def previous_day(ms: Column) -> Column:
    """day text of the moment 24 hours earlier."""
    return millis_day(ms - F.lit(DAY_MS))


def day_range(first: Column, last: Column) -> Column:
    """array of ``yyyyMMdd`` integers from first to last day; empty if reversed."""
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    as_int = F.transform(days, lambda d: F.date_format(d, "yyyyMMdd").cast("int"))
    return F.when(first.isNotNull() & last.isNotNull(), F.coalesce(as_int, F.array().cast("array<int>")))


def to_millis(value: Column) -> Column:
    """F8: small numbers are seconds, large ones already milliseconds."""
    return F.when(value < SECONDS_LIMIT, value * 1000).otherwise(value)
