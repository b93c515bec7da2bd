"""Event time and watermarks (W1-W4). Late rows beyond the delay are dropped by stateful steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.jsonio import first_element_ts, first_seconds, json_ts

DELAY = "5 seconds"
COMMENT_DELAY = "3 seconds"


def watermark(df: DataFrame, column: str, delay: str = DELAY) -> DataFrame:
    """Bounded out-of-orderness on a timestamp column."""
    return df.withWatermark(column, delay)


def json_watermark(
    df: DataFrame, field: str, delay: str = COMMENT_DELAY, value: str = "value", name: str = "event_time"
) -> DataFrame:
    """Time from a JSON field of milliseconds, the epoch when missing or unreadable."""
    return df.withColumn(name, F.timestamp_millis(json_ts(F.col(value), field))).withWatermark(name, delay)


def fallback_watermark(
    df: DataFrame, delay: str, fields: tuple[str, ...] = ("block_timestamp", "timestamp"), value: str = "value",
    name: str = "event_time",
) -> DataFrame:
    """Time from the first present of several fields of seconds."""
    return df.withColumn(name, F.timestamp_millis(first_seconds(F.col(value), *fields))).withWatermark(name, delay)


def list_watermark(df: DataFrame, items: str, delay: str, name: str = "event_time") -> DataFrame:
    """W3, list form: the first element's window start."""
    return df.withColumn(name, F.timestamp_millis(first_element_ts(F.col(items)))).withWatermark(name, delay)
