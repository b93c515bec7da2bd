"""Helpers the operators share: appending columns in Arrow batches, written tables, texts as bytes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.session import shared_dir

#: Rows and bytes of one Arrow batch: a worker holds one batch of texts at a time.
BATCH_ROWS, BATCH_BYTES = "2000", "32m"
#: Bytes that separate words in the contracts that speak of ``[^\x20\x09-\x0D]+``; ``bytes.split()`` uses the same.
SPACES = b" \t\n\r\x0b\x0c"


def prepared(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches, so that very long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    It cuts the lineage: what follows reads committed files, which outlive the
    executors that wrote them.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame without columns that an operator is about to add (its own win a clash of names)."""
    return df.drop(*names)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches a task makes; at its end the memory it is done with goes back to the system, as Python workers live on."""
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def append_columns(
    df: DataFrame,
    fields: list[T.StructField],
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
) -> DataFrame:
    """Add columns computed batch by batch in Python; all other columns pass through.

    ``start`` runs once per task and returns the function of a batch, which gives
    one Arrow array per added field. A column of the same name is replaced.
    """
    names = [f.name for f in fields]
    base = without(df, names)
    schema = T.StructType(base.schema.fields + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            added = compute(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    return base.mapInArrow(lambda batches: released(run(batches)), schema)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a text column; a null stays None."""
    return batch.column(batch.schema.names.index(column)).cast(pa.binary()).to_pylist()


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)
