"""Text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record per line; the schema is given, never inferred."""
    return spark.read.schema(schema).json(path)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a file with one word per line."""
    return spark.read.text(path).select(F.col("value").alias("word")).filter("word <> ''").distinct()


def first_line(spark: SparkSession, path: str) -> str | None:
    row = spark.read.text(path).first()
    return row[0] if row else None
