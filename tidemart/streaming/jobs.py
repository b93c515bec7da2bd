"""Streaming jobs (T6-T8, T10): a stream, a checkpoint, an idempotent sink.

Every sink writes a micro-batch under its batch number, so a batch run again
after a failure replaces what it wrote before: results count each record once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemart.operators import aggregates
from tidemart.operators.routing import (
    clean_cdc, current_config, log_keys, put_is_new, route_dims, split_rows, with_fields,
)
from tidemart.plans import dwd
from tidemart.sinks.days import DayFiles
from tidemart.sinks.dims import DimStore, sync_dim_tables, write_routed
from tidemart.sinks.topics import show_stream
from tidemart.sinks.upsert import UpsertTable
from tidemart.sources.topics import TopicSpec, read_stream
from tidemart.streaming.stateful import FirstVisits
from tidemart.streaming.watermarks import json_watermark

CHECKPOINT_INTERVAL = "30 seconds"


def start(writer: DataStreamWriter, interval: str | None = CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Start with a fixed interval, or with None handle what is there and stop."""
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def finish(writer: DataStreamWriter) -> None:
    """Handle everything available now and wait for the end."""
    start(writer, None).awaitTermination()


def upsert_stream(df: DataFrame, table: UpsertTable, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """Each micro-batch into a keyed table."""
    return (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(table.batch_writer())
    )


def user_visit_stream(log: DataFrame, table: UpsertTable, checkpoint: str) -> DataStreamWriter:
    """Visits per user and day; every batch emits the changed groups only."""
    visits = aggregates.user_visit_agg(dwd.user_behavior_fact(log))
    return upsert_stream(visits, table, checkpoint, "update")


def batch_job(
    df: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    """A stream whose micro-batches run a batch step; the batch is computed once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


def dims_stream(
    cdc: DataFrame, config_changes: Callable[[], DataFrame], store: DimStore, checkpoint: str
) -> DataStreamWriter:
    """J11 on a stream: the config in force is read again for every micro-batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        config = current_config(config_changes())
        write_routed(store, route_dims(batch, config), batch_id)

    return batch_job(cdc, checkpoint, step)


def config_stream(changes: DataFrame, store: DimStore, checkpoint: str) -> DataStreamWriter:
    """S15 on a stream: config changes create and drop dimension tables."""

    def step(batch: DataFrame, batch_id: int) -> None:
        del batch_id
        sync_dim_tables(store, clean_cdc(batch, keep=("ts_ms",)))

    return batch_job(changes, checkpoint, step)


def comment_stream(spark: SparkSession, topic: TopicSpec, field: str = "ts_ms") -> DataStreamWriter:
    """Comment records with their event time, printed."""
    return show_stream(json_watermark(read_stream(spark, topic), field))


def lookup_stream(
    df: DataFrame, lookup: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> DataStreamWriter:
    """J6, S5 on a stream: ``lookup`` runs anew for every micro-batch, so a dimension table that
    was replaced meanwhile is read as it now is. Rows go to a folder per batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        lookup(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return batch_job(df, checkpoint, step)


def log_split_stream(
    raw: DataFrame, order_by: str, path: str, checkpoint: str, visits: FirstVisits
) -> DataStreamWriter:
    """Repaired log records, all outputs of a micro-batch in one partitioned write.

    Records are parsed twice and stay in the JVM: once for the few fields that first visits need,
    which are kept for the batch, once to be split. Records without a device (malformed
    ones too) have no first visit to meet and pass by.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        keyed = log_keys(with_fields(batch))
        marks = keyed.select(order_by, visits.key, "is_new", "ts").persist()
        try:
            rows = split_rows(put_is_new(visits.repair(keyed, batch_id, order_by, marks=marks)), (order_by,))
            rows.write.mode("overwrite").partitionBy("output").parquet(f"{path}/batch={batch_id}")
        finally:
            marks.unpersist()

    return batch_job(raw, checkpoint, step)


def day_files_stream(
    records: DataFrame, files: DayFiles, checkpoint: str, retention_seconds: float | None = None
) -> DataStreamWriter:
    """S11 on a stream: JSON ``value`` records into day folders that are merged as they close."""
    return batch_job(records, checkpoint, files.batch_writer(retention_seconds))
