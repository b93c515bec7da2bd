"""Keyed upsert sink (S7): last row per primary key wins, deletes remove the key."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.latest import latest_per_key
from tidemart.session import complete_folders, folder_names, remove_folders

BATCH = "_batch"
BUCKET = "_bucket"
CODEC = "zstd"


class UpsertTable:
    """A table kept as one change folder per micro-batch plus a merged base.

    A batch costs what it holds, not what the table holds: it is reduced to one
    row per key and written to its own folder. A batch run again after a failure
    overwrites its own folder, so nothing counts twice. Readers merge the newest
    base with the later changes; ``compact`` writes a new base and touches no
    folder a reader may be using.

    With ``buckets``, the columns are those of the first batch, and rows lie in folders by the hash of ``bucket_by`` (the keys, unless named). A
    reader that knows the rows it will meet (``near``) then opens only the buckets they fall in.
    """

    def __init__(
        self, path: str, keys: Sequence[str], order_by: Sequence[str] = (), op: str = "op", compact_every: int = 50,
        buckets: int = 0, bucket_by: Sequence[str] = (),
    ) -> None:
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order_by = list(order_by)
        self.op = op
        self.compact_every = compact_every
        self.buckets = buckets
        self.bucket_by = list(bucket_by) or self.keys

    def bucket(self, columns: Sequence[str] = ()) -> Column:
        """The bucket of a row that has the bucketing columns, or others in their place."""
        names = list(columns) or self.bucket_by
        return F.pmod(F.xxhash64(*names), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, folder: str) -> None:
        if not self.buckets:
            rows.write.mode("overwrite").option("compression", CODEC).parquet(folder)
            return
        placed = rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        placed.write.mode("overwrite").option("compression", CODEC).partitionBy(BUCKET).parquet(folder)

    def _schema(self, spark: SparkSession) -> T.StructType:
        """Columns of a bucketed table, kept beside it: a batch without rows leaves no file to tell them."""
        return spark.read.parquet(f"{self.path}/columns/0").schema

    def append(self, rows: DataFrame, batch_id: int, unique: bool = False) -> None:
        """Write one batch of new, changed and (``op`` = d) deleted rows; ``unique`` if no key occurs twice in it."""
        stamped = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        if self.buckets and not complete_folders(rows.sparkSession, f"{self.path}/columns"):
            stamped.limit(0).write.mode("overwrite").parquet(f"{self.path}/columns/0")
        last = stamped if unique else latest_per_key(stamped, self.keys, [*self.order_by, BATCH])
        self._write(last, f"{self.path}/changes/{batch_id:020d}")
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.compact(rows.sparkSession)

    def batch_writer(self) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``."""
        return self.append

    def _folders(self, spark: SparkSession, before: int | None = None) -> list[str]:
        end = f"{before:020d}" if before is not None else "~"
        bases = [b for b in complete_folders(spark, f"{self.path}/base") if b < end]
        upto = bases[-1] if bases else ""
        changes = [c for c in complete_folders(spark, f"{self.path}/changes") if upto < c < end]
        found = [f"{self.path}/base/{upto}"] if upto else []
        return found + [f"{self.path}/changes/{c}" for c in changes]

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows that a batch has written, deleted ones too; with buckets."""
        folder = f"{self.path}/changes/{batch_id:020d}"
        found = [f"{folder}/{name}" for name in folder_names(spark, folder)]
        return self._of_folders(spark, found)

    def _of_folders(self, spark: SparkSession, found: Sequence[str]) -> DataFrame:
        schema = self._schema(spark)
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)

    def written(self, spark: SparkSession, before: int | None = None) -> bool:
        return bool(self._folders(spark, before))

    def touched(self, near: DataFrame, columns: Sequence[str] = ()) -> list[int]:
        """The buckets some rows fall in; at most ``buckets`` numbers."""
        return [row[0] for row in near.select(self.bucket(columns)).distinct().collect()]

    def history(
        self, spark: SparkSession, before: int | None = None, near: Sequence[int] | None = None, of: DataFrame | None = None
    ) -> DataFrame:
        """Latest row per key with its delete mark and batch number; of batches before one if given.

        ``near`` names the buckets to read. ``of`` has values of the bucketing columns, none null, and rows
        without them are left out before the rest is merged; bucketing columns must then be keys.
        """
        folders = self._folders(spark, before)
        if not folders:
            raise ValueError(f"nothing has been written to {self.path}")
        if not self.buckets:
            rows = spark.read.parquet(*folders)
        else:
            # The buckets' own folders, so that Spark lists and opens no others.
            wanted = None if near is None else {f"{BUCKET}={n}" for n in near}
            found = [f"{f}/{name}" for f in folders for name in folder_names(spark, f) if wanted is None or name in wanted]
            rows = self._of_folders(spark, found)
        if of is not None:
            rows = rows.join(of, self.bucket_by, "left_semi")
        if len(folders) == 1:  # a folder has one row per key
            return rows
        return latest_per_key(rows, self.keys, [*self.order_by, BATCH])

    def read(
        self, spark: SparkSession, before: int | None = None, near: Sequence[int] | None = None, of: DataFrame | None = None
    ) -> DataFrame:
        """Current rows, or those before a batch, which may then be written again."""
        rows = self.history(spark, before, near, of).drop(BATCH)
        if self.op in rows.columns:
            rows = rows.filter(F.col(self.op) != "d").drop(self.op)
        return rows

    def get(self, spark: SparkSession, *key: object) -> DataFrame:
        """The row of one key, if it is there; with buckets, from one bucket alone.

        The key's values come in the order of ``keys``, in the columns' types.
        """
        kinds = dict(self.history(spark).dtypes)
        named = spark.range(1).select(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in zip(self.keys, key, strict=True)])
        near = self.touched(named) if self.buckets and set(self.bucket_by) <= set(self.keys) else None
        rows = self.read(spark, near=near)
        for k, v in zip(self.keys, key, strict=True):
            rows = rows.filter(F.col(k).eqNullSafe(F.lit(v)))
        return rows

    def compact(self, spark: SparkSession) -> None:
        """Merge all changes into a new base. Deletes stay in it, so a late older row stays dead."""
        changes = complete_folders(spark, f"{self.path}/changes")
        bases = complete_folders(spark, f"{self.path}/base")
        if changes and (not bases or bases[-1] < changes[-1]):
            self._write(self.history(spark), f"{self.path}/base/{changes[-1]}")

    def expire(self, spark: SparkSession, retention_seconds: float) -> list[str]:
        """Remove folders that the newest base replaces, once that base is older than the retention.

        The retention is the longest a reader, or a batch that is run again, may still use the folders
        it has listed.
        """
        bases = complete_folders(spark, f"{self.path}/base")
        if not bases:
            return []
        old = [f"{self.path}/base/{b}" for b in bases[:-1]]
        old += [f"{self.path}/changes/{c}" for c in complete_folders(spark, f"{self.path}/changes") if c <= bases[-1]]
        return remove_folders(spark, old, f"{self.path}/base/{bases[-1]}/_SUCCESS", time.time() - retention_seconds)


def write_upsert(
    df: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str], batch_id: int | None = None
) -> UpsertTable:
    """S7 for a single batch, by default under the number after the last one."""
    table = UpsertTable(path, keys, order_by)
    if batch_id is None:
        earlier = complete_folders(df.sparkSession, f"{table.path}/changes")
        batch_id = int(earlier[-1]) + 1 if earlier else 0
    table.append(df, batch_id)
    return table
