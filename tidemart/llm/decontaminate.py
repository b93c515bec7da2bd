"""Benchmark decontamination: a broadcast hash set of test n-grams scanned over token windows.

A word is a run of digits, a-z or characters beyond ASCII after A-Z is lower-cased.
A window is ``size`` consecutive words of an item; an item of fewer words, but not
none, is one window. The windows' rolling hashes form the broadcast set; a window of a
document whose hash is in the set is compared word by word before it counts.

The set is broadcast only up to ``max_bytes``; a larger benchmark is cut by hash into
blocks of that size, and the documents are scanned once per block with the hits so far
carried along.

Defined cases: a null or wordless text has no words, no hits and an empty list of items;
a null or wordless item has no window; a null item id is left out of the lists though its windows hit;
repeated documents each get their row, repeated items count by id; an empty benchmark
hits nothing; input columns named as the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import append_columns, field, raw_texts, written

WINDOW = 10
MAX_BROADCAST_BYTES = 32 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def word_bounds(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the words, in order."""
    return [m.span() for m in _WORD.finditer(text.translate(_LOWER))]


def item_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, item_id) per distinct window of an item; words are joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, ids = [], []
            items = batch.column(0).to_pylist()
            for item, text in zip(items, raw_texts(batch, text_col), strict=True):
                words = words_of(text)
                if words:
                    span = min(size, len(words))
                    found = {b" ".join(words[i:i + span]) for i in range(len(words) - span + 1)}
                    grams.extend(found)
                    ids.extend([item] * len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.binary()), pa.array(ids, pa.string())], names=["window", "item_id"]
            )

    source = benchmark.select(F.col(id_col).cast("string").alias(id_col), text_col)
    return source.mapInArrow(run, "window binary, item_id string").distinct()


class WindowSet:
    """Hashes, words and items of the windows of one block, by window length."""

    def __init__(self, rows: list[tuple[bytes, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        grouped: dict[bytes, set[str]] = {}
        for gram, item in rows:
            grouped.setdefault(gram, set()).update([] if item is None else [item])
        by_length: dict[int, list[tuple[list[int], tuple[str, ...]]]] = {}
        for gram, items in grouped.items():
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in gram.split()]
            by_length.setdefault(len(ids), []).append((ids, tuple(items)))
        self.lengths = {}
        for length, windows in by_length.items():
            ids = np.array([w for w, _ in windows], np.int64)
            hashes = rolling_hash(ids.ravel(), length)[::length]
            order = np.argsort(hashes, kind="stable")
            self.lengths[length] = (hashes[order], ids[order], [windows[i][1] for i in order])

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, length, items) of every occurrence in a sequence of word ids."""
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for length, (hashes, grams, items) in self.lengths.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(at):
                continue
            found = rolling_hash(ids, length)[at]
            first, last = np.searchsorted(hashes, found), np.searchsorted(hashes, found, side="right")
            for p in np.flatnonzero(last > first):
                here = ids[at[p]:at[p] + length]
                for k in range(first[p], last[p]):
                    if np.array_equal(grams[k], here):
                        yield int(at[p]), length, items[k]


def rolling_hash(ids: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of every window of a sequence."""
    out = np.zeros(len(ids) - length + 1, np.uint64)
    values = ids.astype(np.uint64)
    for k in range(length):
        out = out * _BASE + values[k:k + len(out)]
    return out


def scan(docs: DataFrame, block: WindowSet, text_col: str = "text") -> DataFrame:
    """Add n_words, hit_spans (merged word ranges, end exclusive) and hit_items; earlier hits are merged in."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    span = T.ArrayType(T.StructType([field("start", T.LongType()), field("end", T.LongType())]))
    carried = "hit_spans" in docs.columns
    if carried:
        docs = docs.withColumnsRenamed({"hit_spans": "__spans", "hit_items": "__items"})

    def start():
        known = shared.value
        lookup = known.vocabulary.get

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            counts, spans, items = [], [], []
            texts = raw_texts(batch, text_col)
            old = [[]] * len(texts)
            old_items = [[]] * len(texts)
            if carried:
                old = batch.column(batch.schema.names.index("__spans")).to_pylist()
                old_items = batch.column(batch.schema.names.index("__items")).to_pylist()
            for text, was, had in zip(texts, old, old_items, strict=True):
                words = words_of(text)
                ids = np.fromiter(map(lookup, words, repeat(0)), np.int64, len(words))
                ranges, names = [(s["start"], s["end"]) for s in was], set(had)
                for first, length, found in known.find(ids):
                    ranges.append((first, first + length))
                    names.update(found)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(ranges)])
                items.append(sorted(names))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return [pa.array(counts, pa.int64()), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))]

        return compute

    fields = [field("n_words", T.LongType()), field("hit_spans", span), field("hit_items", T.ArrayType(T.StringType()))]
    return append_columns(docs, fields, start).drop("__spans", "__items")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    text_col: str = "text",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Documents with n_words, hit_spans, hit_items, n_hit, n_items and contaminated."""
    windows = item_windows(benchmark, size)
    total = windows.agg(F.sum(F.length("window") + F.length(F.coalesce("item_id", F.lit(""))) + 100)).first()[0] or 0
    blocks = -(-total // max_bytes) or 1
    out = without_old(docs)
    for k in range(blocks):
        block = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        rows = [(bytes(r["window"]), r["item_id"]) for r in block.collect()]
        out = scan(out, WindowSet(rows), text_col)
        if blocks > 1:
            out = written(out, "windows-found")
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.withColumns({"n_hit": n_hit, "n_items": F.size("hit_items").cast("long")}).withColumn(
        "contaminated", F.col("n_hit") > 0
    )


def without_old(docs: DataFrame) -> DataFrame:
    return docs.drop("n_words", "hit_spans", "hit_items", "n_hit", "n_items", "contaminated", "__spans", "__items")


def cut_words(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """The text without the given word ranges, from each first word's start to its last word's end."""
    bounds = word_bounds(text)
    out, at = [], 0
    for first, end in ranges:
        out.append(text[at:bounds[first][0]])
        at = bounds[end - 1][1]
    return b"".join([*out, text[at:]])


def cleaned(docs: DataFrame, benchmark: DataFrame, drop_share: float = 0.5, **options) -> DataFrame:
    """Documents with the hit spans cut out of ``text``; those hit in more than ``drop_share`` of their words go.

    All columns of the input stay, and no others are added. ``n_chars``, where there
    is one, follows the text.
    """
    columns = docs.columns
    found = decontaminate(docs, benchmark, **options).filter(F.col("n_hit") <= drop_share * F.col("n_words"))
    texts = found.withColumnRenamed("text", "__text")

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        spans = batch.column(batch.schema.names.index("hit_spans")).to_pylist()
        kept = [
            cut_words(t, [(s["start"], s["end"]) for s in r]) if r else t
            for t, r in zip(raw_texts(batch, "__text"), spans, strict=True)
        ]
        return [pa.array(kept, pa.binary()).cast(pa.string())]

    out = append_columns(texts, [field("text", T.StringType())], lambda: compute)
    if "n_chars" in columns:
        changed = F.size("hit_spans") > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*columns)


def items_digest(column: str = "hit_items") -> Column:
    """Lowercase hex SHA-256 of the item ids, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(column), ","), 256)
