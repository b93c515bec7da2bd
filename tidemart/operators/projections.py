"""Projections and filters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import times
from tidemart.functions.jsonio import row_json


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    Spark may copy a projected expression into every place that uses it, such as
    a pushed-down filter. Costly ones (JSON parsing, hashing) go through a
    one-row generator, which it never copies.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def cdc_after(df: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Row image of change records as columns; deletes carry no new image."""
    parsed = df.filter("op <> 'd'").select(F.from_json("after", schema).alias("after"), *keep)
    return parsed.select("after.*", *keep)


def cdc_image(df: DataFrame, schema: str, position: bool = False) -> DataFrame:
    """Row image of every change with ``op`` and ``ts_ms``: before for deletes, else after.

    ``position`` adds ``pos``, the change's place in its log, which orders changes of one
    millisecond.
    """
    text = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    more = [F.try_element_at("source", F.lit("pos")).try_cast("bigint").alias("pos")] if position else []
    names = ["op", "ts_ms", "pos"][:2 + len(more)]
    return df.select(F.from_json(text, schema).alias("image"), "op", "ts_ms", *more).select("image.*", *names)


def unparsed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: (change records, records whose envelope or kind of change could not be read)."""
    known = F.col("op").isin("r", "c", "u", "d") & F.col("source").isNotNull()
    return df.filter(known), df.filter(~F.coalesce(known, F.lit(False)))


def with_event_time(df: DataFrame, ms_col: str, name: str = "event_time", proc: str | None = None) -> DataFrame:
    """Event time from epoch milliseconds and, if named, the processing time."""
    out = df.withColumn(name, times.event_time(F.col(ms_col)))
    return out.withColumn(proc, F.current_timestamp()) if proc else out


def filter_status(df: DataFrame, column: str, code: str | int) -> DataFrame:
    """Rows with one status code."""
    return df.filter(F.col(column) == F.lit(code))


def behavior_flags(df: DataFrame) -> DataFrame:
    """P5: visit flags from the visit type code."""
    visit = F.col("visit_type")
    return df.withColumns({
        "is_new_visit": visit == "new",
        "is_return_visit": visit.isin("return", "return_no_buy"),
        "is_purchase_visit": visit == "purchase",
    })


def info_row(df: DataFrame, rowkey: str, fields: Sequence[str]) -> DataFrame:
    """Dimension row of a key and one nested ``info`` family."""
    return df.select(F.col(rowkey).alias("rowkey"), F.struct(*fields).alias("info"))


def filter_day(df: DataFrame, day: str | None = None, column: str = "dt", time: str | None = None) -> DataFrame:
    """Rows of one day, today unless a day is given.

    ``time`` names the timestamp the day comes from: the same condition on it, as a range,
    reaches the scan, where one on the formatted day cannot.
    """
    wanted: Column = F.lit(day) if day else F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    rows = df.filter(F.col(column) == wanted)
    if time is None:
        return rows
    begin = F.to_timestamp(F.lit(day)) if day else F.date_trunc("day", F.current_timestamp())
    return rows.filter((F.col(time) >= begin) & (F.col(time) < begin + F.expr("interval 1 day")))


def row_to_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text with explicit nulls."""
    return df.select(row_json(df.columns).alias(name))


def schema_from_names(columns: Sequence[str]) -> T.StructType:
    """Column types implied by column names; the first matching rule wins."""

    def type_of(name: str) -> T.DataType:
        if name in ("order_id", "id", "stock_num"):
            return T.IntegerType()
        if "time" in name:
            return T.StringType()
        if "amount" in name or "price" in name:
            return T.DecimalType(10, 2)
        if name.startswith("is_"):
            return T.BooleanType()
        return T.StringType()

    return T.StructType([T.StructField(c, type_of(c)) for c in columns])


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast columns to a schema by name; unreadable values become null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def rename_snake_to_camel(df: DataFrame) -> DataFrame:
    """``sink_table`` becomes ``sinkTable``."""
    return df.toDF(*[re.sub(r"_+(\w)", lambda m: m.group(1).upper(), c.lower()) for c in df.columns])
