"""Topic source.

A topic is a Kafka topic or, where no broker is at hand, a folder of files with
one record per line. Both give the same columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STARTS = ("earliest", "latest")


@dataclass(frozen=True)
class TopicSpec:
    """Where a topic lives and where reading starts."""

    name: str
    servers: str | None = None
    folder: str | None = None
    start: str = "earliest"
    options: dict[str, str] = field(default_factory=dict)

    def kafka_options(self) -> dict[str, str]:
        if self.start not in STARTS:
            raise ValueError(f"start must be one of {STARTS}, not {self.start!r}")
        if not self.servers:
            raise ValueError("a Kafka topic needs servers")
        # New partitions are found at every micro-batch; no interval is needed.
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": self.start,
            "failOnDataLoss": "true",
            **self.options,
        }


def read_stream(spark: SparkSession, spec: TopicSpec, schema: str | None = None) -> DataFrame:
    """Streaming records as ``value`` text, or parsed with a schema.

    A record without a value (tombstone) is no row (S1b); a value that does not
    parse gives null columns.
    """
    if spec.folder:
        raw = spark.readStream.format("text").options(**spec.options).load(spec.folder)
    else:
        raw = spark.readStream.format("kafka").options(**spec.kafka_options()).load()
    return _decode(raw, schema)


def read_batch(spark: SparkSession, spec: TopicSpec, schema: str | None = None) -> DataFrame:
    """The topic's present content as a batch."""
    if spec.folder:
        raw = spark.read.format("text").options(**spec.options).load(spec.folder)
    else:
        raw = spark.read.format("kafka").options(**{**spec.kafka_options(), "startingOffsets": "earliest"}).load()
    return _decode(raw, schema)


def _decode(raw: DataFrame, schema: str | None) -> DataFrame:
    values = raw.select(F.col("value").cast("string").alias("value")).filter("value IS NOT NULL")
    if schema is None:
        return values
    return values.select(F.from_json("value", schema).alias("row")).select("row.*")
