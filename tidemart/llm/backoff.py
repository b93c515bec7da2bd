"""Stupid-backoff language-model scores from n-gram counts of all documents.

A word w after context u scores c(u w) / c(u) if that n-gram occurs in another document,
else ``ALPHA`` times its score after the shorter context; a single word scores c(w) / N. A
document's own occurrences are left out of every count, so a text is not its own proof.
A word of no other document counts ``UNSEEN`` times.

1. Documents are taken in chunks of rows; a chunk's different n-grams are counted once,
   so a frequent n-gram is one entry per chunk, not per occurrence.
2. The count tables are partitioned by hash: entries go to buckets of the hash range,
   packed in arrays; a bucket sums the chunks' counts.
3. Each bucket answers the chunks that asked, with the counts of what they asked in the same
   order; chunks and answers are joined and scores summed per document.

What is shuffled is compressed first: the lower bytes of the keys' differences are even noise and
go as they are, all other byte planes and the texts of a chunk as entropy-coded blocks.

Nothing is sampled or cut off; a bucket holds about ``BUCKET_BYTES`` of text's n-grams and a
chunk ``CHUNK_ROWS`` documents, however large the corpus. N-grams are 64-bit hashes.

Defined cases: a null or wordless text has no words, score zero and no mean; repeated
documents are documents of their own; null ids stay null; an empty table gives no rows;
other columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import raw_texts, written

ORDER = 3
ALPHA, UNSEEN = 0.4, 0.5
CHUNK_ROWS = 2000
BUCKET_BYTES = 4 << 20
_KEPT_WORDS = 300_000
_CODEC = "zstd"


class WordHashes(dict):
    """64-bit hashes of words, remembered for the words of a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _KEPT_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grams:
    """N-grams of the documents of a chunk: one number per occurrence and per different n-gram."""

    def __init__(self, texts: list[bytes | None], order: int, hashes: WordHashes):
        split = [t.split() if t else [] for t in texts]
        self.lengths = np.array([len(w) for w in split], np.int64)
        n = int(self.lengths.sum())
        words = np.fromiter((hashes[w] for part in split for w in part), np.uint64, n)
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        self.place = np.arange(n) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        gram = _mixed(words)
        self.at, self.keys = [], []
        for k in range(order):
            if k:
                gram = _mixed(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[k:] + np.uint64(k))
            at = np.flatnonzero(self.place >= k)  # the n-gram's last word
            self.at.append(at)
            self.keys.append(gram[at - k])

    def counted(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(different keys, number of each occurrence, count of each key, count of each occurrence's key in its document)."""
        number, keys = pd.factorize(self.keys[k])
        pair, _ = pd.factorize(number * max(len(self.lengths), 1) + self.doc[self.at[k]])
        return keys, number, np.bincount(number, minlength=len(keys)), np.bincount(pair)[pair] if len(pair) else pair


def _in_order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(the different n-grams of all orders, ascending; where each stood)."""
    every = np.concatenate(keys)
    place = np.argsort(every, kind="stable")
    return every[place], place


def _chunked(docs: DataFrame) -> DataFrame:
    """(doc_id, text, chunk, row): rows of one file in runs of ``CHUNK_ROWS``, whatever the tasks; other frames are written first."""
    place = [
        F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / CHUNK_ROWS)).alias("chunk"),
        F.col("_metadata.row_index").alias("row"),
    ]
    try:
        return docs.select("doc_id", "text", *place)
    except AnalysisException:
        return written(docs.select("doc_id", "text"), "documents").select("doc_id", "text", *place)


def _asked(docs: DataFrame, order: int, buckets: int) -> DataFrame:
    """Different n-grams with counts, packed by part of a chunk and bucket; the count's low bit tells of several documents.

    A part is the rows of a chunk that came in one batch; usually it is the whole chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            chunks, rows, texts = batch.column(1).to_numpy(), batch.column(2).to_numpy(), raw_texts(batch)
            for a, b in _runs(chunks):
                grams = Grams(texts[a:b], order, hashes)
                keys, coded = [], []
                for k in range(order):
                    found, number, count, own = grams.counted(k)
                    several = np.zeros(len(found), bool)
                    several[number[own < count[number]]] = True
                    keys.append(found)
                    coded.append(count * 2 + several)
                key, place = _in_order(keys)
                code = np.concatenate(coded)[place]
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                some = [(s, e) for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True) if e > s]
                same = lambda value, some=some: pa.array([int(value)] * len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(bucket[s]) for s, _ in some], pa.int64()),
                    same(chunks[a]), same(rows[a]), same(rows[b - 1]),
                    pa.array([_packed(key[s:e]) for s, e in some], pa.binary()),
                    pa.array([_planes(code[s:e]) for s, e in some], pa.binary()),
                ], names=["bucket", "chunk", "first", "last", "keys", "codes"])

    return docs.select("text", "chunk", "row").mapInArrow(
        run, "bucket long, chunk long, first long, last long, keys binary, codes binary")


def _planes(values: np.ndarray, noise: int = 0) -> bytes:
    """Integers with their byte planes apart, compressed but for the lowest ``noise`` planes."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    head = np.array([len(values), noise], "<u4").tobytes()
    return head + planes[:noise].tobytes() + pa.compress(planes[noise:].tobytes(), _CODEC, asbytes=True)


def _values(raw: bytes) -> np.ndarray:
    n, noise = np.frombuffer(raw, "<u4", 2).tolist()
    cut = 8 + n * noise
    upper = pa.decompress(raw[cut:], n * (8 - noise), _CODEC, asbytes=True)
    planes = np.frombuffer(raw[8:cut] + upper, np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    usual = int(keys[-1] - keys[0]) // len(keys)
    return _planes(np.diff(keys, prepend=np.uint64(0)), usual.bit_length() // 8)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(_values(raw), dtype=np.uint64)


def _runs(chunks: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the rows of each chunk in a batch."""
    borders = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
    return [(a, b) for a, b in zip(borders, borders[1:]) if b > a]


def _blocks(chunked: DataFrame) -> DataFrame:
    """The rows of a chunk that came in one batch as one compressed block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=_CODEC)
        for batch in batches:
            chunks, blocks = batch.column(0).to_numpy(), []
            rows = pa.RecordBatch.from_arrays(batch.columns[1:], names=["doc_id", "text", "row"])
            runs = _runs(chunks)
            for a, b in runs:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                    out.write_batch(rows.slice(a, b - a))
                blocks.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(chunks[a]) for a, _ in runs], pa.int64()), pa.array(blocks, pa.binary())], names=["chunk", "block"])

    rows = chunked.select("chunk", F.col("doc_id").cast("long").alias("doc_id"), "text", "row")
    return rows.mapInArrow(run, "chunk long, block binary")


def _answers(group: pa.Table) -> pa.Table:
    """The counts of a bucket's n-grams for each part that asked, in the part's own order of them.

    An n-gram that a single document holds gets zero.
    """
    keys = [_unpacked(raw) for raw in group["keys"].to_pylist()]
    codes = [_values(raw).astype(np.int64) for raw in group["codes"].to_pylist()]
    every, number = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(number, weights=np.concatenate(codes) >> 1, minlength=len(every)).astype(np.int64)
    out, at = [], 0
    for code in codes:
        mine = total[number[at:at + len(code)]]
        at += len(code)
        out.append(_planes(np.where((mine > code >> 1) | (code & 1 == 1), mine, 0)))
    return group.select(["bucket", "chunk", "first", "last"]).append_column("totals", pa.array(out, pa.binary()))


def scored(texts: list[bytes | None], totals: np.ndarray, total: int, order: int) -> list[np.ndarray]:
    """(words, sum of base-10 logarithms, words that backed off) per document of a part.

    ``totals`` has the corpus counts of the part's different n-grams in ascending order of keys.
    """
    grams = Grams(texts, order, WordHashes())
    n = len(grams.doc)
    counted = [grams.counted(k) for k in range(order)]
    _, place = _in_order([found for found, *_ in counted])
    corpus = np.zeros(len(place), np.int64)
    corpus[place] = totals
    others, begun = [], 0  # per n: occurrences in other documents, at the n-gram's last word
    for k, (found, number, _, own) in enumerate(counted):
        full = np.zeros(n, np.int64)
        full[grams.at[k]] = np.maximum(corpus[begun:begun + len(found)][number] - own, 0)
        begun += len(found)
        others.append(full)
    rest = np.maximum(total - grams.lengths[grams.doc], 1)
    score = np.where(others[0] > 0, others[0], UNSEEN) / rest
    best = np.ones(n, np.int64)
    for k in range(1, order):
        here = grams.place >= k
        context = np.zeros(n, np.int64)
        context[1:] = others[k - 1][:-1]
        seen = here & (others[k] > 0)
        score = np.where(seen, others[k] / np.maximum(context, 1), np.where(here, ALPHA * score, score))
        best = np.where(seen, k + 1, best)
    backed = best < np.minimum(grams.place + 1, order)
    docs = len(texts)
    return [grams.lengths, np.bincount(grams.doc, np.log10(score), minlength=docs),
            np.bincount(grams.doc, backed, minlength=docs).astype(np.int64)]


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, log10_score, mean_log10, n_backoff) per document."""
    chunked = _chunked(docs)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = words = 0
        for batch in batches:
            for t in raw_texts(batch):
                size, words = size + len(t or b""), words + (len(t.split()) if t else 0)
        yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([words], pa.int64())], names=["size", "words"])

    sums = docs.select("text").mapInArrow(measure, "size long, words long").agg(F.sum("size"), F.sum("words")).first()
    size, total = sums[0] or 0, sums[1] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    answers = _asked(chunked, order, buckets).groupBy("bucket").applyInArrow(
        _answers, "bucket long, chunk long, first long, last long, totals binary")

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = [pa.ipc.open_stream(raw).read_all() for raw in left["block"].to_pylist()]
        left = pa.concat_tables(blocks).sort_by("row")
        rows, texts = left["row"].to_numpy(), left["text"].cast(pa.binary()).to_pylist()
        parts: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
        for bucket, first, last, raw in zip(*(right[c].to_pylist() for c in ("bucket", "first", "last", "totals")), strict=True):
            parts.setdefault((first, last), []).append((bucket, raw))
        n_words, logs, backed = (np.zeros(len(texts), t) for t in (np.int64, np.float64, np.int64))
        for (first, last), found in parts.items():  # rows of no part have no words
            a, b = np.searchsorted(rows, first), np.searchsorted(rows, last, side="right")
            totals = np.concatenate([_values(raw) for _, raw in sorted(found)]).astype(np.int64)
            n_words[a:b], logs[a:b], backed[a:b] = scored(texts[a:b], totals, total, order)
        return pa.table({
            "doc_id": left["doc_id"], "n_words": pa.array(n_words), "log10_score": pa.array(logs), "n_backoff": pa.array(backed)})

    out = _blocks(chunked).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        joined, "doc_id long, n_words long, log10_score double, n_backoff long")
    return out.select(
        "doc_id", "n_words", "log10_score",
        F.when(F.col("n_words") > 0, F.col("log10_score") / F.col("n_words")).alias("mean_log10"), "n_backoff")
