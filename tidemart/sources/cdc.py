"""Change-capture source (S3): the envelope as columns, row images as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.schemas import CDC_ENVELOPE
from tidemart.sources.topics import TopicSpec, read_batch, read_stream


def read_cdc(spark: SparkSession, spec: TopicSpec, stream: bool = True) -> DataFrame:
    """Snapshot and change records of all captured tables (op r, c, u or d)."""
    return read_stream(spark, spec, CDC_ENVELOPE) if stream else read_batch(spark, spec, CDC_ENVELOPE)
