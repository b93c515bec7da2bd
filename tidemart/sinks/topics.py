"""Append sink for JSON records (S6) and console output."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.functions.jsonio import row_json
from tidemart.sources.topics import TopicSpec


#: Records of one file of a topic folder: a compressed file is read by one task, whatever its size.
FILE_RECORDS = 100_000


def as_records(df: DataFrame) -> DataFrame:
    """One JSON ``value`` per row; a frame that is only ``value`` text passes as it is."""
    if df.dtypes == [("value", "string")]:
        return df
    return df.select(row_json(df.columns).alias("value"))


def _kafka_options(spec: TopicSpec) -> dict[str, str]:
    # Acknowledged by all replicas, without producer-side repeats.
    return {
        "kafka.bootstrap.servers": spec.servers or "",
        "topic": spec.name,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        **spec.options,
    }


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """A task keeps a file of some parts open at once: sorting by part would put all records on its disk first."""
    name, most = "spark.sql.maxConcurrentOutputFileWriters", "16"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_batch_json(df: DataFrame, spec: TopicSpec, part: Column | None = None) -> None:
    """Append a batch to a topic.

    Files of a folder are compressed and hold ``FILE_RECORDS`` records at most. ``part`` spreads the records over folders ``part=`` of the topic, each
    to be read as a topic of its own, without a shuffle.
    """
    records = as_records(df)
    if spec.folder and part is not None:
        named = df.select(row_json(df.columns).alias("value"), part.alias("part"))
        with open_writers(df.sparkSession):
            named.write.mode("append").option("maxRecordsPerFile", FILE_RECORDS).partitionBy("part").text(spec.folder, compression="gzip")
    elif spec.folder:
        records.write.mode("append").option("maxRecordsPerFile", FILE_RECORDS).text(spec.folder, compression="gzip")
    else:
        records.write.format("kafka").options(**_kafka_options(spec)).save()


def write_stream_json(df: DataFrame, spec: TopicSpec, checkpoint: str) -> DataStreamWriter:
    """Writer that appends a stream to a topic; the caller sets a trigger and starts it."""
    writer = as_records(df).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if spec.folder:
        return writer.format("text").option("path", spec.folder)
    return writer.format("kafka").options(**_kafka_options(spec))


def show_stream(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    """Print a stream."""
    return df.writeStream.format("console").option("numRows", rows).option("truncate", "false")


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Mark rows before printing several outputs together."""
    return df.select(F.lit(label).alias("label"), "*")
