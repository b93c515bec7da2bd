"""Keyed state in batch form: visitor repair and deduplication."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.joins import keyed_join


def fix_is_new(log: DataFrame, order_by: str, key: str = "mid", is_new: str = "is_new", ts: str = "ts") -> DataFrame:
    """A visitor marked new on another day than the first visit is not new.

    The first record of a device in ``order_by`` (a number) sets the first visit:
    its own day if marked new, the day before otherwise; records without a time are
    neither first nor repaired. That record is found by a map-side reducible
    aggregate; no task holds all records of one device.
    """
    return repair_visits(log, first_visits(log, order_by, key, is_new, ts), key, is_new, ts)


def first_visits(log: DataFrame, order_by: str, key: str = "mid", is_new: str = "is_new", ts: str = "ts") -> DataFrame:
    """T1, first step: (``key``, first_day) of each device with a timed record."""
    day = F.to_date(F.timestamp_millis(ts))
    first = F.when(F.col(is_new).eqNullSafe("1"), day).otherwise(F.date_sub(day, 1))
    timed = log.filter(F.col(ts).isNotNull() & F.col(key).isNotNull())
    return timed.groupBy(key).agg(F.min_by(first, order_by).alias("first_day"))


def repair_visits(
    log: DataFrame, first: DataFrame, key: str = "mid", is_new: str = "is_new", ts: str = "ts"
) -> DataFrame:
    """T1, second step: records marked new on another day than their device's first are not new."""
    known = first.select(F.col(key).alias("_mid"), F.col("first_day").alias("_first"))
    joined = keyed_join(log, known, [key], ["_mid"], "left")
    late = F.col(is_new).eqNullSafe("1") & (F.col("_first") != F.to_date(F.timestamp_millis(ts)))
    return joined.withColumn(is_new, F.when(late, F.lit("0")).otherwise(F.col(is_new))).drop("_mid", "_first")


def dedup_latest(
    df: DataFrame, key: str, ts: str, order_by: str, chunk: int = 1_000_000, known: DataFrame | None = None
) -> DataFrame:
    """Keep a record only if its time exceeds every earlier one of its key.

    Arrival order ``order_by`` is a unique number. It is cut into chunks: the
    greatest time before a chunk comes from per-chunk maxima, the rest from a
    window within the chunk, so a hot key is spread over its chunks. ``known``
    (``_known``, ``_latest``) gives keys times from before the first record.
    """
    rows = df.withColumn("_chunk", F.call_function("div", F.col(order_by), F.lit(chunk)))
    maxima = rows.groupBy(F.col(key).alias("_key"), F.col("_chunk").alias("_c")).agg(F.max(ts).alias("_max"))
    before = Window.partitionBy("_key").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    earlier = maxima.select("_key", "_c", F.max("_max").over(before).alias("_earlier"))
    if known is not None:
        earlier = earlier.join(known, F.col("_key").eqNullSafe(F.col("_known")), "left")
        earlier = earlier.select("_key", "_c", F.greatest("_earlier", "_latest").alias("_earlier"))
    joined = rows.join(earlier, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_chunk") == F.col("_c")))
    inside = Window.partitionBy(key, "_chunk").orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.greatest(F.col("_earlier"), F.max(ts).over(inside))
    return (
        joined.withColumn("_seen", seen)
        .filter(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen")))
        .drop("_seen", "_earlier", "_key", "_c", "_chunk")
    )


def dedup_exact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop exact repeats of a record (of ``columns`` if given)."""
    return df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()


def bloom_size(expected: int, rate: float) -> tuple[int, int]:
    """Bits and hash count of a bloom filter for an expected number and error rate."""
    rate = max(rate, 5e-324)
    bits = max(8, math.ceil(-expected * math.log(rate) / math.log(2) ** 2))
    bits = -(-bits // 8) * 8
    return bits, max(1, round(bits / expected * math.log(2)))


class GrowingBloom:
    """A bloom filter that keeps its error rate at any number of keys.

    It is a list of filters: when the last one holds the keys it was made for, a
    filter for twice as many at half the rate follows, so all errors together stay
    below ``rate``. A bit takes a bit, eight to a byte as ``numpy.packbits`` puts them, and
    rows are looked up a block at a time, so a task holds little more than the filter.
    """

    BLOCK = 1 << 16

    def __init__(self, expected: int, rate: float) -> None:
        self.expected, self.rate = max(1, expected), rate
        self.layers: list[tuple[np.ndarray, int, int]] = []  # packed bits, their number, hashes
        self.room = 0

    def _grow(self) -> None:
        n = len(self.layers)
        size, hashes = bloom_size(self.expected << n, self.rate / 2 ** (n + 1))
        self.layers.append((np.zeros(-(-size // 8), dtype=np.uint8), size, hashes))
        self.room = self.expected << n

    @staticmethod
    def _places(a: np.ndarray, b: np.ndarray, size: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
        """Byte and mask of each row's bits."""
        steps = np.arange(1, hashes + 1, dtype=np.uint64)
        at = ((a[:, None] + steps[None, :] * b[:, None]) % np.uint64(size)).astype(np.int64)
        return at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8)

    def keep(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Mark rows whose hash pair is not yet in the filter, and add them.

        Equal pairs within one call count once, the first row of them being kept.
        """
        first = ~pd.DataFrame({"a": h1, "b": h2}).duplicated().to_numpy()
        a, b = h1.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
        new = np.zeros(len(a), dtype=bool)
        at = 0
        while at < len(a):
            if not self.room:
                self._grow()
            end = min(len(a), at + self.room, at + self.BLOCK)  # no more rows than the last filter has room for
            fresh = first[at:end].copy()
            for bits, size, hashes in self.layers:
                byte, mask = self._places(a[at:end], b[at:end], size, hashes)
                fresh &= ~((bits[byte] & mask) != 0).all(axis=1)
            bits, size, hashes = self.layers[-1]
            byte, mask = self._places(a[at:end][fresh], b[at:end][fresh], size, hashes)
            np.bitwise_or.at(bits, byte.ravel(), mask.ravel())
            self.room -= int(fresh.sum())
            new[at:end] = fresh
            at = end
        return new

    def packed(self) -> bytes:
        return pickle.dumps((self.expected, self.rate, self.room, [
            (bits.tobytes(), size, hashes) for bits, size, hashes in self.layers]))

    @classmethod
    def unpacked(cls, raw: bytes) -> GrowingBloom:
        expected, rate, room, layers = pickle.loads(raw)
        out = cls(expected, rate)
        out.room = room
        out.layers = [(np.frombuffer(bits, np.uint8).copy(), size, hashes) for bits, size, hashes in layers]
        return out


def dedup_bloom(
    df: DataFrame, key: Sequence[str] = ("order_id", "ts_ms"), expected: int = 1_000_000, rate: float = 0.01,
    approximate: bool = False, shards: int = 200,
) -> DataFrame:
    """T4: one record per key. Exact unless ``approximate``.

    The approximate form hashes keys to ``shards`` tasks and lets each test a bloom
    filter that begins with room for ``expected`` keys and grows; it may drop a share
    ``rate`` of new records but never keeps a repeat. All repeats of a key reach one
    task: the exact form reduces them before the shuffle and is the better batch choice.
    """
    if not approximate:
        return df.dropDuplicates(list(key))
    hashed = df.withColumns({
        "_h1": F.xxhash64(*key), "_h2": F.xxhash64(F.lit("second"), *key),
    }).repartition(shards, "_h1")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bloom = GrowingBloom(expected, rate)
        for pdf in batches:
            mask = bloom.keep(pdf.pop("_h1").to_numpy(), pdf.pop("_h2").to_numpy())
            yield pdf[mask]

    return hashed.mapInPandas(keep, df.schema)

