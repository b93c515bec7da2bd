"""Best-two-fit packing: as few sequences as possible, each of at most a window of ids.

A bin takes the longest piece left, then again and again the longest that still fits. When
none fits, its smallest piece (but its first) makes way for two unpacked pieces that
together fill the widened gap more tightly, until no two do.

Only lengths matter to that rule, and there are at most ``WINDOW`` of them. So the driver
runs it over the numbers of pieces per length: a bin's lengths are one pattern, used as many
times as every step would find its lengths again, and the plan is a few thousand patterns
however many documents there are. Pieces then find their places by themselves:

1. Tasks cut the documents into pieces and number those of each length as they come.
2. The numbers of the tasks before are added: each piece has its rank within its length.
3. Length and rank name a pattern, a repetition and a place in it.

Only documents of more than a window are cut, into whole windows and a rest.

Defined cases: a null or empty text is the end id alone; repeated documents are pieces of their
own; null ids stay null; an empty table gives no rows; other columns of the input do not
matter, whatever they are called.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import written
from tidemart.llm.tokens import encoded, vocabulary_path

WINDOW, END_ID = 4096, 1
#: Ids of the pieces of one written batch.
BATCH_IDS = 1 << 20
_PIECES = "task int, place long, doc_id long, piece int, start long, length int, ids binary"


class Pattern(NamedTuple):
    """Lengths of the pieces of a bin, in their order, and how many bins are so."""

    bins: int
    lengths: tuple[int, ...]


class _Left:
    """Unpacked pieces per length while one bin is filled."""

    def __init__(self, count: dict[int, int], lengths: list[int]):
        self.count, self.lengths = count, lengths
        self.used: Counter[int] = Counter()
        self.most: Counter[int] = Counter()

    def of(self, length: int) -> int:
        return self.count[length] - self.used[length]

    def take(self, length: int) -> None:
        self.used[length] += 1
        self.most[length] = max(self.most[length], self.used[length])

    def longest(self, room: int) -> int:
        """The longest unpacked piece that fits, or 0."""
        at = bisect_right(self.lengths, room) - 1
        while at >= 0 and not self.of(self.lengths[at]):
            at -= 1
        return self.lengths[at] if at >= 0 else 0

    def best_two(self, room: int, better_than: int) -> tuple[int, int] | None:
        """The two unpacked pieces that fill the room best, if more than ``better_than``; of equals, the pair with the longest."""
        some = np.array([n for n in self.lengths[:bisect_right(self.lengths, room - 1)] if self.of(n)], np.int64)
        if not len(some):
            return None
        single = np.array([self.of(n) == 1 for n in some.tolist()])
        at = np.searchsorted(some, np.minimum(some, room - some), side="right") - 1
        at -= (at == np.arange(len(some))) & single
        total = np.where(at >= 0, some + some[at], 0)
        best = int(total.max())
        if best <= better_than:
            return None
        k = int(np.flatnonzero(total == best)[-1])
        return int(some[k]), int(some[at[k]])


def plan(counts: dict[int, int], window: int = WINDOW) -> list[Pattern]:
    """Best-two-fit of so many pieces per length, as patterns with their repetitions."""
    count = {length: n for length, n in counts.items() if n}
    if count and not 0 < min(count) <= max(count) <= window:
        raise ValueError("a piece has between one id and a window of ids")
    lengths, patterns = sorted(count), []
    while lengths:
        left, bin_, room = _Left(count, lengths), [], window
        while fits := left.longest(room):
            bin_.append(fits)
            left.take(fits)
            room -= fits
        while room and len(bin_) > 1:
            smallest = bin_[-1]
            pair = left.best_two(room + smallest, smallest)
            if pair is None:
                break
            left.used[smallest] -= 1
            for length in pair:
                left.take(length)
            bin_ = sorted([*bin_[:-1], *pair], reverse=True)
            room += smallest - sum(pair)
        # The next bin is the same as long as each step finds what it found here.
        bins = min((count[n] - left.most[n]) // used + 1 for n, used in left.used.items() if used)
        patterns.append(Pattern(bins, tuple(bin_)))
        for n, used in left.used.items():
            count[n] -= used * bins
        lengths = [n for n in lengths if count[n]]
    return patterns


class Places:
    """Sequence and offset by length and rank within the length, from a plan."""

    def __init__(self, patterns: Sequence[Pattern]):
        slots: list[tuple[int, int, int, int, tuple[int, ...]]] = []  # length, pattern, first sequence, bins, offsets
        sequence = 0
        for number, (bins, lengths) in enumerate(patterns):
            offsets: dict[int, list[int]] = {}
            at = 0
            for length in lengths:
                offsets.setdefault(length, []).append(at)
                at += length
            slots += [(n, number, sequence, bins, tuple(o)) for n, o in offsets.items()]
            sequence += bins
        slots.sort()
        self.sequences = sequence
        self.per_bin = np.array([len(s[4]) for s in slots], np.int64)
        pieces = self.per_bin * np.array([s[3] for s in slots], np.int64)
        self.begin = np.cumsum(pieces) - pieces
        self.sequence = np.array([s[2] for s in slots], np.int64)
        self.offsets = np.array([o for s in slots for o in s[4]], np.int64)
        self.first_offset = np.cumsum(self.per_bin) - self.per_bin
        # Where a length's pieces begin if all pieces are numbered by length and rank.
        self.of_length = np.zeros(max((s[0] for s in slots), default=0) + 1, np.int64)
        for slot, begin in zip(reversed(slots), reversed(self.begin.tolist()), strict=True):
            self.of_length[slot[0]] = begin

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number = self.of_length[length] + rank
        slot = np.searchsorted(self.begin, number, side="right") - 1
        turn, place = np.divmod(number - self.begin[slot], self.per_bin[slot])
        return self.sequence[slot] + turn, self.offsets[self.first_offset[slot] + place]


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids, and with their number among the pieces of their length in their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        end = np.array([end_id], "<u4")
        for batch, coded in encoded(batches, vocabulary):
            rows, held = [], 0
            for doc, found in zip(batch.column(0).to_pylist(), coded, strict=True):
                ids = np.concatenate([found, end]).astype("<u4")
                for number, at in enumerate(range(0, len(ids), window)):
                    part = ids[at:at + window]
                    rows.append((task, int(seen[len(part)]), doc, number, at, len(part), part.tobytes()))
                    seen[len(part)] += 1
                    held += len(part)
                    if held >= BATCH_IDS:
                        yield _batch(rows)
                        rows, held = [], 0
            yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in _PIECES.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset); ids are little-endian unsigned 32-bit integers."""
    cut = written(pieces(docs, vocabulary or vocabulary_path(), window, end_id), "pieces")
    counts = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row per length, at most a window of them
    places = Places(plan({row["length"]: row["n"] for row in totals}, window))
    # A length has one row per task here, however many pieces it has.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begun"))
    # Written, its size is known when the join is planned: small, it is sent to the pieces, and these stay where they are.
    ranked = cut.join(written(begun, "ranks"), ["length", "task"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids",
        (F.col("begun") + F.col("place")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, ids): the packed sequences; a window bounds what is gathered of one."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n_pieces"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return rows.select("sequence_id", "n_pieces", joined.alias("ids"))
