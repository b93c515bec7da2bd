"""Collects queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Types two engines render alike: decimals as double, times and dates as text."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, STAMP)
        elif kind == "date":
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


def sql_time(column: str) -> str:
    """The SQL text of a timestamp rendered as ``comparable`` does."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
