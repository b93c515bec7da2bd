"""Application log: parse, repair the new-visitor mark, split."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.operators.dedup import fix_is_new
from tidemart.operators.routing import log_keys, put_is_new, split_rows, with_fields


def repaired(raw: DataFrame, order_by: str) -> DataFrame:
    """Records with a ``fields`` map whose new-visitor mark is repaired."""
    return put_is_new(fix_is_new(log_keys(with_fields(raw)), order_by)).drop("mid", "is_new", "ts")


def log_split(raw: DataFrame, order_by: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """All outputs as rows of (``output``, ``value``), from raw text with an arrival number.

    One pass, so one write partitioned by ``output`` serves all topics.
    """
    return split_rows(repaired(raw, order_by), keep)
