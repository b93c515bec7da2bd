"""Keyed state on streams.

State lives in the state store, partitioned by key. The rows of a key in one
micro-batch reach one task, so a trigger must bound the batch
(``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``); the batch forms in
``operators.dedup`` have no such bound.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemart.operators.dedup import GrowingBloom, dedup_latest, first_visits, repair_visits
from tidemart.session import complete_folders
from tidemart.sinks.upsert import UpsertTable

#: Buckets of a keyed table on a stream; a table of many files needs more.
BUCKETS = 16

Update = Callable[[tuple, Iterator[pd.DataFrame], "_Written"], Iterator[pd.DataFrame]]


def _timeout(ttl_ms: int | None) -> str:
    return GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout


class _Written:
    """T5: a state whose last field is the time of its last write, from which it expires."""

    def __init__(self, state: GroupState, ttl_ms: int | None) -> None:
        self.state, self.ttl_ms = state, ttl_ms

    @property
    def exists(self) -> bool:
        return self.state.exists

    @property
    def value(self) -> int:
        return self.state.get[0]

    def write(self, value: int) -> None:
        self.state.update((value, self.state.getCurrentProcessingTimeMs() if self.ttl_ms else 0))

    def renew(self) -> None:
        """Set what is left of the time since the last write; being read renews nothing."""
        if self.ttl_ms and self.state.exists:
            left = self.state.get[1] + self.ttl_ms - self.state.getCurrentProcessingTimeMs()
            self.state.setTimeoutDuration(max(1, left))


def _with_ttl(step: Update, ttl_ms: int | None) -> Update:
    """T5: state expires ``ttl_ms`` after it was last written."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        written = _Written(state, ttl_ms)
        yield from step(key, batches, written)
        written.renew()

    return update


class FirstVisits:
    """T1, T5 on a stream without state in a task: first visits in a keyed table.

    A micro-batch adds the devices it is the first to bring, found by a map-side reducible
    aggregate, and joins its records with the table; a device holding most of a batch is
    split like any join key. The table lies in buckets of the device and a batch opens those
    of its devices. An entry counts for ``ttl_ms`` from when it was written.
    """

    def __init__(self, path: str, key: str = "mid", ttl_ms: int | None = None, buckets: int = BUCKETS) -> None:
        self.key, self.ttl_ms = key, ttl_ms
        self.table = UpsertTable(path, [key], buckets=buckets)

    def repair(
        self, batch: DataFrame, batch_id: int, order_by: str, is_new: str = "is_new", ts: str = "ts", marks: DataFrame | None = None
    ) -> DataFrame:
        """The batch with its marks repaired. ``marks`` are these columns of its records, kept, if the batch itself is costly to compute."""
        marks = batch if marks is None else marks
        spark, now = batch.sparkSession, F.unix_millis(F.current_timestamp())
        fresh = first_visits(marks, order_by, self.key, is_new, ts).withColumns({"written": now, "op": F.lit("u")})
        near = self.table.touched(marks)
        if self.table.written(spark, batch_id):
            known = self.table.read(spark, batch_id, near)
            if self.ttl_ms:
                known = known.filter(F.col("written") + self.ttl_ms > now)
            fresh = fresh.join(known.select(self.key), self.key, "left_anti")
        self.table.append(fresh, batch_id)
        current = self.table.read(spark, near=near)
        here = current.join(marks.select(self.key).distinct(), self.key, "left_semi")
        return repair_visits(batch, here, self.key, is_new, ts)


def fix_is_new_stream(
    df: DataFrame, order_by: str, key: str = "mid", is_new: str = "is_new", ts: str = "ts",
    ttl_ms: int | None = None,
) -> DataFrame:
    """T1 on a stream; within a batch records count in ``order_by`` order."""
    rows = df.withColumn("_day", F.unix_date(F.to_date(F.timestamp_millis(ts))))

    def step(_key: tuple, batches: Iterator[pd.DataFrame], state: _Written) -> Iterator[pd.DataFrame]:
        held = []
        if not state.exists:
            held = list(batches)
            timed = [b[b["_day"].notna()] for b in held]
            firsts = pd.concat([b.nsmallest(1, order_by) for b in timed])
            if len(firsts):
                row = firsts.nsmallest(1, order_by).iloc[0]
                state.write(int(row["_day"]) if row[is_new] == "1" else int(row["_day"]) - 1)
        for pdf in itertools.chain(held, batches):
            if state.exists:
                wrong = (pdf[is_new] == "1") & pdf["_day"].notna() & (pdf["_day"] != state.value)
                pdf.loc[wrong, is_new] = "0"
            yield pdf.drop(columns="_day")

    return rows.groupBy(key).applyInPandasWithState(
        _with_ttl(step, ttl_ms), df.schema, "first_day long, written long", "append", _timeout(ttl_ms)
    )


class LatestTimes:
    """T2, T5 on a stream without state in a task: the greatest time of each key in a keyed table.

    A micro-batch is the batch form ``dedup_latest`` begun from the table's times, so a key
    holding most of a batch spreads over the chunks of its arrival order. The table lies in
    buckets of the key and a batch opens those of its keys. A time counts for ``ttl_ms``
    from when it was last raised.
    """

    def __init__(self, path: str, key: str, ts: str, ttl_ms: int | None = 86_400_000, buckets: int = BUCKETS) -> None:
        self.key, self.ts, self.ttl_ms = key, ts, ttl_ms
        self.table = UpsertTable(path, [key], op="_none", buckets=buckets)

    def keep(self, batch: DataFrame, batch_id: int, order_by: str, chunk: int = 1_000_000) -> DataFrame:
        """The rows whose time exceeds every earlier one of their key; ``order_by`` is a number unique in the batch."""
        spark, now = batch.sparkSession, F.unix_millis(F.current_timestamp())
        known = None
        if self.table.written(spark, batch_id):
            known = self.table.read(spark, batch_id, self.table.touched(batch))
            if self.ttl_ms:
                known = known.filter(F.col("_raised") + self.ttl_ms > now)
            known = known.select(F.col(self.key).alias("_known"), F.col(self.ts).alias("_latest"))
        raised = batch.filter(F.col(self.ts).isNotNull()).groupBy(self.key).agg(F.max(self.ts).alias(self.ts))
        if known is not None:
            met = raised.join(known, F.col(self.key).eqNullSafe(F.col("_known")), "left")
            raised = met.filter(F.col("_latest").isNull() | (F.col(self.ts) > F.col("_latest"))).drop("_known", "_latest")
        self.table.append(raised.withColumn("_raised", now), batch_id)
        return dedup_latest(batch, self.key, self.ts, order_by, chunk, known)


def dedup_exact_batches(path: str, columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """T3 on a stream, for ``foreachBatch``: repeats of any earlier record are dropped, however old.

    New rows go to ``path/rows``, their hashes to ``path/hashes``, a folder per batch. A
    batch run again replaces its own folders and does not look at them.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
        fresh = batch.withColumn("_digest", digest).dropDuplicates(["_digest"])
        earlier = [f"{path}/hashes/{b}" for b in complete_folders(spark, f"{path}/hashes") if b < f"{batch_id:020d}"]
        if earlier:
            fresh = fresh.join(spark.read.parquet(*earlier), "_digest", "left_anti")
        # The rows first: hashes mark them as written only when they are.
        fresh.write.mode("overwrite").parquet(f"{path}/rows/{batch_id:020d}")
        written = spark.read.parquet(f"{path}/rows/{batch_id:020d}").select("_digest")
        written.write.mode("overwrite").parquet(f"{path}/hashes/{batch_id:020d}")

    return step


def dedup_exact_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``dedup_exact_batches`` kept."""
    folders = [f"{path}/rows/{b}" for b in complete_folders(spark, f"{path}/rows")]
    return spark.read.parquet(*folders).drop("_digest")


def dedup_exact_stream(df: DataFrame, columns: Sequence[str], time: str, delay: str) -> DataFrame:
    """T3 with bounded state: repeats within the watermark delay only are dropped."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(columns))


def dedup_bloom_stream(
    df: DataFrame, key: Sequence[str] = ("order_id", "ts_ms"), expected: int = 1_000_000, rate: float = 0.01,
    shards: int = 200,
) -> DataFrame:
    """T4 on a stream: a growing bloom filter per shard of keys, in state."""
    rows = df.withColumns({"_h1": F.xxhash64(*key), "_h2": F.xxhash64(F.lit("second"), *key)})
    rows = rows.withColumn("_shard", F.pmod("_h1", F.lit(shards)).cast("int"))

    def step(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bloom = GrowingBloom.unpacked(state.get[0]) if state.exists else GrowingBloom(expected, rate)
        for pdf in batches:
            keep = bloom.keep(pdf["_h1"].to_numpy(), pdf["_h2"].to_numpy())
            yield pdf.loc[keep].drop(columns=["_h1", "_h2", "_shard"])
        state.update((bloom.packed(),))

    return rows.groupBy("_shard").applyInPandasWithState(
        step, df.schema, "bits binary", "append", GroupStateTimeout.NoTimeout
    )
