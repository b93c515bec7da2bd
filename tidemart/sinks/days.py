"""Day-partitioned file sink."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.jsonio import json_field
from tidemart.functions.times import millis_text, to_millis
from tidemart.session import complete_folders, folder_files, folder_names, remove_folders

ERROR_DAY = "error_bucket"  # fixed value: partition of records without a readable time
ROWS_PER_FILE = 1_000_000
#: A day's files are closed after this time without a record, at this age, or at this size.
IDLE_SECONDS, AGE_SECONDS, FILE_BYTES = 300, 600, 128 << 20


def day_of(value: Column, ts_field: str) -> Column:
    """``yyyyMMdd`` of the time field of a JSON record, given in seconds or milliseconds."""
    ts = json_field(value, ts_field, "bigint")
    return F.coalesce(millis_text(to_millis(ts), "yyyyMMdd"), F.lit(ERROR_DAY))


def write_day_partitioned(
    df: DataFrame, ts_field: str, path: str, mode: str = "append", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """JSON ``value`` records as text files below ``day=``.

    The rebalance hint gathers each day's rows into few files and lets adaptive
    execution split a day that holds most rows over several tasks.
    """
    dated = df.select("value", day_of(F.col("value"), ts_field).alias("day"))
    dated.hint("rebalance", "day").write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(
        "day"
    ).text(path)


def write_unpartitioned(df: DataFrame, path: str, mode: str = "append", rows_per_file: int = ROWS_PER_FILE) -> None:
    """S11 without a partition field."""
    df.select("value").write.mode(mode).option("maxRecordsPerFile", rows_per_file).text(path)


class DayFiles:
    """S11 on a stream: day folders per micro-batch, later merged into few large files.

    A micro-batch writes ``batches/<number>/day=``, and run again it replaces its own folder. ``roll``
    merges what a day has got since it was last merged, once that is idle, old or large enough, into
    ``rolled/<last batch merged>-<roll>/day=``; it is one Spark job for all days that are due. A merge that did not
    finish has no commit mark and counts for nothing. Readers take a day's merged files and the
    batches behind the last one merged, so a record is seen once at any time. ``expire`` removes what merges
    replaced, which keeps the listing as long as the open batches.
    """

    def __init__(
        self, path: str, ts_field: str | None, idle: float = IDLE_SECONDS, age: float = AGE_SECONDS,
        file_bytes: int = FILE_BYTES,
    ) -> None:
        self.path, self.ts_field = path.rstrip("/"), ts_field
        self.idle, self.age, self.file_bytes = idle, age, file_bytes

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """A micro-batch of JSON ``value`` records; without a time field all go to one day named ``all``."""
        day = day_of(F.col("value"), self.ts_field) if self.ts_field else F.lit("all")
        dated = batch.select("value", day.alias("day")).hint("rebalance", "day")
        dated.write.mode("overwrite").partitionBy("day").text(f"{self.path}/batches/{batch_id:020d}")

    def batch_writer(self, retention_seconds: float | None = None) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: write a batch, then merge what is due of the batches before it, which are final."""

        def step(batch: DataFrame, batch_id: int) -> None:
            self.write(batch, batch_id)
            self.roll(batch.sparkSession, before=batch_id)
            if retention_seconds is not None:
                self.expire(batch.sparkSession, retention_seconds)

        return step

    def _rolled(self, spark: SparkSession) -> tuple[dict[str, str], dict[str, list[str]]]:
        """For each day the last batch merged, and its merged folders."""
        upto: dict[str, str] = {}
        folders: dict[str, list[str]] = {}
        for roll in complete_folders(spark, f"{self.path}/rolled"):
            for name in folder_names(spark, f"{self.path}/rolled/{roll}"):
                upto[name] = max(upto.get(name, ""), roll.split("-")[0])
                folders.setdefault(name, []).append(f"{self.path}/rolled/{roll}/{name}")
        return upto, folders

    def _batches(self, spark: SparkSession, end: str = "~") -> list[tuple[str, str]]:
        """Batch and day folder name of all that finished batches below a number hold."""
        done = [b for b in complete_folders(spark, f"{self.path}/batches") if b < end]
        return [(b, name) for b in done for name in folder_names(spark, f"{self.path}/batches/{b}")]

    def folders(self, spark: SparkSession, days: Sequence[str] | None = None) -> list[str]:
        """The folders that hold each record once; of some days only if named."""
        wanted = None if days is None else {f"day={d}" for d in days}
        # Batches are listed first: a merge that ends meanwhile then hides what it holds, and is read itself.
        batches = self._batches(spark)
        upto, rolled = self._rolled(spark)
        found = [f for name, fs in sorted(rolled.items()) if wanted is None or name in wanted for f in fs]
        return found + [
            f"{self.path}/batches/{b}/{name}" for b, name in batches
            if b > upto.get(name, "") and (wanted is None or name in wanted)]

    def read(self, spark: SparkSession, days: Sequence[str] | None = None) -> DataFrame:
        """``value`` and ``day``; naming days opens their folders only."""
        return self._open(spark, self.folders(spark, days))

    @staticmethod
    def _open(spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], "value string, day string")
        day = F.regexp_extract("_metadata.file_path", "/day=([^/]+)/[^/]+$", 1)
        return spark.read.text(folders).select("value", day.alias("day"))

    def roll(self, spark: SparkSession, before: int | None = None, now: float | None = None) -> list[str]:
        """Merge the days that are due, of batches below a number if given; the days merged."""
        now = time.time() if now is None else now
        upto, _ = self._rolled(spark)
        batches = self._batches(spark, "~" if before is None else f"{before:020d}")
        open_: dict[str, list[str]] = {}
        for b, name in batches:
            if b > upto.get(name, ""):
                open_.setdefault(name, []).append(f"{self.path}/batches/{b}/{name}")
        files_of: dict[str, int] = {}
        for name, folders in open_.items():
            files = [f for folder in folders for f in folder_files(spark, folder)]
            size, times = sum(n for n, _ in files), [t for _, t in files]
            if times and (now - max(times) >= self.idle or now - min(times) >= self.age or size >= self.file_bytes):
                files_of[name] = max(1, -(-size // self.file_bytes))
        if not files_of:
            return []
        rows = self._open(spark, [f for name in files_of for f in open_[name]])
        # A day of several files is spread by a hash of its records, a day of one stays together.
        share = F.create_map(*[F.lit(x) for name, n in files_of.items() for x in (name.split("=")[1], n)])
        salt = F.pmod(F.xxhash64("value"), F.try_element_at(share, F.col("day")))
        last = max(b for b, name in batches)
        done = len(complete_folders(spark, f"{self.path}/rolled"))
        rows.withColumn("_part", salt).hint("rebalance", "day", "_part").drop("_part").write.mode("overwrite").partitionBy(
            "day").text(f"{self.path}/rolled/{last}-{done:06d}")
        return sorted(name.split("=")[1] for name in files_of)

    def expire(self, spark: SparkSession, retention_seconds: float) -> list[str]:
        """Remove batch folders whose days are all merged, if the last merge is older than the retention: the longest
        a reader may still use the folders it has listed."""
        upto, _ = self._rolled(spark)
        rolls = complete_folders(spark, f"{self.path}/rolled")
        if not rolls:
            return []
        held: dict[str, list[str]] = {}
        for b, name in self._batches(spark):
            held.setdefault(b, []).append(name)
        old = [f"{self.path}/batches/{b}" for b, names in held.items() if all(b <= upto.get(n, "") for n in names)]
        newest = max(rolls)
        return remove_folders(spark, old, f"{self.path}/rolled/{newest}/_SUCCESS", time.time() - retention_seconds)
