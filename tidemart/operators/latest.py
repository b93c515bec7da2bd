"""Latest row per key and top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values of each key.

    The filter on the row number lets Spark keep one row per key in every map
    task before the shuffle, so a key holding most rows stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return df.withColumn(_RANK, F.row_number().over(window)).filter(f"{_RANK} = 1").drop(_RANK)


def current_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], op: str = "op") -> DataFrame:
    """State after replaying changes: latest row per key, deleted keys removed."""
    return latest_per_key(df, keys, order_by).filter(F.col(op) != "d").drop(op)


def latest_n(df: DataFrame, column: str, n: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """O1: the n newest rows; ``ties`` makes the choice repeatable."""
    return df.orderBy(F.col(column).desc(), *[F.col(t) for t in ties]).limit(n)
