"""The given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import configure


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, with zone-less timestamps read as instants of the session zone."""
    return _instants(configure(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def load_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # The glob keeps a table stored as one file readable as a stream.
    return _instants(spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]"))


def _instants(df: DataFrame) -> DataFrame:
    casts = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
    return df.withColumns(casts) if casts else df
