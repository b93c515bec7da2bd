"""Token ids in binary files: Simple-8b words with escapes and per-block offsets.

A word of 64 bits holds a selector in its top four bits and, below, as many ids as fit
at one width: the selectors stand for 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2 and 1 ids. An
id of more than 60 bits is an escape: a word of selector 0, then the id as a word of
its own, whose places a block lists. The encoder takes the most ids that fit at each
step; fits and words are computed for whole blocks at once.

File: magic, blocks, then the blocks' offsets, first id numbers and count, and the
magic again. Block: counts of ids, words, documents and escapes (4 x u32), document ids
(i64), ids per document (u32), flags (u8: 1 null id, 2 continues the block before), zeros
to a multiple of 8, escape places (u32, likewise filled), words (u64). All little-endian.

Documents are sorted by id over all files (null first, ties by the text's hash); each task writes one
file, under a name of its own attempt, into the shared folder, and its row of the manifest
counts only if the task succeeds. Readers open the files the manifest names.

Defined cases: a null or empty text is the end id alone; repeated documents are written
as often as they occur, in any order among themselves if their texts are equal; an empty
table gives no file and no rows; other columns of the input do not matter.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import written
from tidemart.llm.tokens import encoded, vocabulary_path
from tidemart.session import shared_dir

MAGIC = b"TMS8B\x00\x00\x01"
BLOCK_IDS = 1 << 16
END_ID = 2
#: Ids per word, by selector; selector 0 is the escape. The width is 60 // count.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, places of escaped ids among the words)."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    take = np.zeros(n, np.int64)
    selector = np.zeros(n, np.int64)
    for s in range(len(COUNTS) - 1, 0, -1):
        count, width = int(COUNTS[s]), 60 // int(COUNTS[s])
        if n >= count:
            wide = np.concatenate([[0], np.cumsum(ids >> np.uint64(width) > 0)])
            fits = np.flatnonzero(wide[count:] == wide[:-count])
            take[fits], selector[fits] = count, s
    at, starts, steps = 0, [], np.maximum(take, 1).tolist()
    while at < n:
        starts.append(at)
        at += steps[at]
    first = np.array(starts, np.int64)
    chosen = selector[first]
    place = np.arange(len(first)) + np.concatenate([[0], np.cumsum(chosen == 0)[:-1]]) if len(first) else first
    words = np.zeros(len(first) + int((chosen == 0).sum()), np.uint64)
    for s in range(1, len(COUNTS)):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            count, width = int(COUNTS[s]), 60 // int(COUNTS[s])
            packed = np.full(len(mine), s << 60, np.uint64)
            for k in range(count):
                packed |= ids[first[mine] + k] << np.uint64(k * width)
            words[place[mine]] = packed
    escaped = np.flatnonzero(chosen == 0)
    words[place[escaped] + 1] = ids[first[escaped]]
    return words, place[escaped] + 1


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    raw = np.zeros(len(words), bool)
    raw[escapes] = True
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = np.where(raw, 1, COUNTS[np.where(raw, 0, selector)])
    at = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in range(1, len(COUNTS)):
        mine = np.flatnonzero((selector == s) & ~raw)
        width = 60 // int(COUNTS[s])
        mask = np.uint64((1 << width) - 1)
        for k in range(int(COUNTS[s]) if len(mine) else 0):
            out[at[mine] + k] = words[mine] >> np.uint64(k * width) & mask
    out[at[raw]] = words[raw]
    return out


def _filled(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


class Writer:
    """Writes documents into one file, a block at a time; a long document spans blocks."""

    def __init__(self, stream, block_ids: int = BLOCK_IDS):
        self.stream, self.block_ids = stream, block_ids
        self.at = self.total = self.docs = 0
        self.blocks: list[tuple[int, int]] = []
        self._clear()
        self._put(MAGIC)

    def _clear(self) -> None:
        self.parts: list[np.ndarray] = []
        self.entries: list[tuple[int, int, int]] = []
        self.held = 0

    def _put(self, raw: bytes) -> None:
        self.stream.write(raw)
        self.at += len(raw)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs += 1
        at, flags = 0, int(doc is None)
        while True:
            part = ids[at:at + self.block_ids - self.held]
            self.parts.append(part)
            self.entries.append((doc or 0, len(part), flags))
            self.held += len(part)
            at += len(part)
            if self.held >= self.block_ids:
                self._flush()
            if at >= len(ids):
                return
            flags |= 2

    def _flush(self) -> None:
        if not self.entries:
            return
        words, escapes = encode(np.concatenate(self.parts))
        docs, counts, flags = zip(*self.entries, strict=True)
        self.blocks.append((self.at, self.total))
        self.total += self.held
        self._put(struct.pack("<4I", self.held, len(words), len(docs), len(escapes)))
        self._put(np.array(docs, "<i8").tobytes())
        self._put(_filled(np.array(counts, "<u4").tobytes() + np.array(flags, "<u1").tobytes()))
        self._put(_filled(escapes.astype("<u4").tobytes()))
        self._put(words.astype("<u8").tobytes())
        self._clear()

    def close(self) -> None:
        self._flush()
        self._put(np.array(self.blocks, "<u8").reshape(-1, 2).tobytes() + struct.pack("<Q", len(self.blocks)) + MAGIC)


class Reader:
    """Random access to the blocks of a file."""

    def __init__(self, stream, size: int):
        self.stream = stream
        if self._get(0, 8) != MAGIC or self._get(size - 8, 8) != MAGIC:
            raise ValueError("not a complete token file")
        n = struct.unpack("<Q", self._get(size - 16, 8))[0]
        self.blocks = np.frombuffer(self._get(size - 16 - 16 * n, 16 * n), "<u8").reshape(-1, 2)

    def _get(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document ids, ids per document, flags, ids)."""
        at = int(self.blocks[number][0])
        ids, n_words, n_docs, n_escapes = struct.unpack("<4I", self._get(at, 16))
        sizes = [8 * n_docs, -(-5 * n_docs // 8) * 8, -(-4 * n_escapes // 8) * 8, 8 * n_words]
        raw = self._get(at + 16, sum(sizes))
        cut = np.cumsum([0, *sizes])
        docs = np.frombuffer(raw, "<i8", n_docs, cut[0])
        counts = np.frombuffer(raw, "<u4", n_docs, cut[1])
        flags = np.frombuffer(raw, "<u1", n_docs, cut[1] + 4 * n_docs)
        escapes = np.frombuffer(raw, "<u4", n_escapes, cut[2])
        out = decode(np.frombuffer(raw, "<u8", n_words, cut[3]), escapes)
        if len(out) != ids:
            raise ValueError("a damaged block")
        return docs, counts, flags, out

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(id, ids, CRC-32 of the ids as 32-bit integers) per document, reading block by block."""
        doc, n, crc, begun = None, 0, 0, False
        for number in range(len(self.blocks)):
            docs, counts, flags, ids = self.block(number)
            raw, at = ids.astype("<u4").tobytes(), 0
            for d, count, flag in zip(docs.tolist(), counts.tolist(), flags.tolist(), strict=True):
                if not flag & 2:
                    if begun:
                        yield doc, n, crc
                    doc, n, crc, begun = None if flag & 1 else d, 0, 0, True
                crc = zlib.crc32(raw[4 * at:4 * (at + count)], crc)
                n, at = n + count, at + count
        if begun:
            yield doc, n, crc


def write_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all documents in ascending id order; the manifest (part, file, n_ids, n_docs)."""
    path = vocabulary or vocabulary_path()
    place, root = fs.FileSystem.from_uri(folder)
    place.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, writer = TaskContext.get(), None
        store, top = fs.FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.s8b"
        for batch, coded in encoded(batches, path):
            if not batch.num_rows:
                continue
            if writer is None:
                writer = Writer(store.open_output_stream(f"{top}/{name}"))
            for doc, ids in zip(batch.column(0).to_pylist(), coded, strict=True):
                writer.add(doc, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            writer.close()
            writer.stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([task.partitionId()], pa.int64()), pa.array([name]), pa.array([writer.total], pa.int64()),
                 pa.array([writer.docs], pa.int64())], names=["part", "file", "n_ids", "n_docs"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("__tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "__tie").sortWithinPartitions("doc_id", "__tie").select("doc_id", "text")
    return written(ordered.mapInArrow(run, "part long, file string, n_ids long, n_docs long"), "token-manifest")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, so the running sum over all of them is small.
    placed = manifest.select("part", "file", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, first in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                with store.open_input_file(f"{top}/{name}") as stream:
                    rows, at = [], first
                    for doc, n, crc in Reader(stream, stream.size()).documents():
                        rows.append((doc, at, n, crc))
                        at += n
                        if len(rows) >= 10_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    files = max(1, manifest.count())
    return placed.repartitionByRange(files, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the token files to the shared folder and give their documents as read back."""
    folder = shared_dir(docs.sparkSession, "token-files")
    folder = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1)
    return read_files(write_files(docs, folder, vocabulary), folder)
