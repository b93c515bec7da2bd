"""Change records to dimension tables as one job.

Config changes and data changes come in one log, and each data record is routed by the config that
was in force at its own place in it, however records and config changes share micro-batches.
Table drops and creations take their place in the same order: what was written to a table before its last
drop is gone, what comes after is kept. The config log must not lag behind the data: a
config change that arrives in a later micro-batch than records behind it does not move those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators.projections import unparsed
from tidemart.operators.routing import (
    CONFIG_TABLE, config_intervals, position, route_dims_as_of, sink_definitions, sink_states,
)
from tidemart.sinks.dims import DimStore, write_routed
from tidemart.sinks.upsert import UpsertTable
from tidemart.streaming.jobs import batch_job


class DimsJob:
    """Routes a log of change records into dimension tables.

    The config's changes are kept in a keyed table; they are as many as the config had changes, and the joins
    on them are sized by Spark. ``routed`` has every record's sink as it was decided, ``dirty`` the records
    that could not be read, each in a folder per micro-batch.
    """

    def __init__(self, store: DimStore, root: str, project: bool = False) -> None:
        self.store, self.root, self.project = store, root.rstrip("/"), project
        # Deletes are rows of this log like any other, so no column is its delete mark.
        self.log = UpsertTable(f"{self.root}/config", ["at", "before", "after"], op="_none")

    def step(self, batch: DataFrame, batch_id: int) -> None:
        known, dirty = unparsed(batch)
        dirty.write.mode("overwrite").parquet(f"{self.root}/dirty/batch={batch_id}")
        placed = position(known)
        is_config = F.col("source")["table"] == CONFIG_TABLE
        new = placed.filter(is_config).select("op", "before", "after", "at")
        self.log.append(new, batch_id)
        changes = self.log.read(batch.sparkSession, batch_id + 1)
        states = sink_states(sink_definitions(changes))
        self._define(sink_definitions(new), states)
        routed = route_dims_as_of(placed.filter(~is_config), config_intervals(changes), states, self.project)
        routed.write.mode("overwrite").parquet(f"{self.root}/routed/batch={batch_id}")
        rows = batch.sparkSession.read.parquet(f"{self.root}/routed/batch={batch_id}")
        write_routed(self.store, rows.filter("lives"), batch_id, "at")

    def _define(self, new: DataFrame, states: DataFrame) -> None:
        """Drops and creations of a batch by their net effect; a table for each config row at most."""
        touched = new.groupBy("sink_table").agg(F.bool_or(~F.col("creates")).alias("drops")).join(states, "sink_table")
        for row in touched.collect():
            if row["drops"]:
                self.store.drop(row["sink_table"])
            if row["exists"]:
                self.store.create(row["sink_table"])

    def stream(self, cdc: DataFrame, checkpoint: str) -> DataStreamWriter:
        return batch_job(cdc, checkpoint, self.step)
