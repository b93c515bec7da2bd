"""JSON and number expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_json(columns: Iterable[str | Column]) -> Column:
    """One JSON object per row, with nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_field(text: Column, field: str, kind: str = "string") -> Column:
    """one field of a JSON text; null when absent, malformed or of another type."""
    return F.get_json_object(text, f"$.{field}").try_cast(kind)


def json_ts(text: Column, field: str) -> Column:
    """Numeric time field, 0 when missing or unreadable."""
    return F.coalesce(json_field(text, field, "bigint"), F.lit(0).cast("bigint"))


def first_seconds(text: Column, *fields: str) -> Column:
    """Milliseconds from the first present field of seconds."""
    found = F.coalesce(*[json_field(text, f, "bigint") for f in fields])
    return found * 1000


def first_element_ts(items: Column, field: str = "window_start_time") -> Column:
    """The time of a list of JSON texts is that of its first element."""
    return json_field(F.try_element_at(items, F.lit(1)), field, "bigint")


def append_to_list(list_text: Column, item: Column) -> Column:
    """JSON list text with one more element; null text starts a new list."""
    current = F.coalesce(F.from_json(list_text, "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.array_append(current, item))


def amount(text: Column, precision: int = 16, scale: int = 2) -> Column:
    """amount carried as text to an exact decimal; unreadable text is null."""
    return text.try_cast(f"decimal({precision},{scale})")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """0 unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0))
