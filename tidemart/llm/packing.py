"""Lexical retrieval packing: windows filled with a seed document's best BM25 neighbours.

Texts become token ids, each document's closed by an end id. A document's full windows
stand alone; its rest of less than a window goes to a shard of ``SHARD_TOKENS`` ids or so,
whichever comes: shards only bound what a task holds. A window starts with a seed, asks the
inverted indexes of all shards and takes unused neighbours by falling BM25 score; the one
that does not fit is cut, and its rest is the next seed.

Rests of one shard are filled by one task. Otherwise chains of windows run side by side, in
rounds: each chain's seed is scored against every unused rest, the best of all shards come
to the driver, and one that several chains want goes to the highest score. A window that
lost too many asks again in the next round. What the chains' last windows hold is put
together at the end, so only one window needs padding. Scores are exact, every unused rest
is a candidate, and so the work grows with seeds times documents. The driver holds a length, a mark and the
places in windows of every rest.

With ``every`` only documents whose id it divides ask, and each asks once (``asked``), in one pass over
shards of documents as they come: a query is offered its best rests of all shards up to ``REACH`` times its share of
all ids, a rest offered to several queries goes to the highest score, and one offered to none goes to the query
it scores highest with. A query's windows hold its own rest, then the others by falling score. No rest
stays behind, the driver holds the queries alone, and the work is a pass of all documents for each query.

The inverse document frequency is ln((N - n + 0.5) / (n + 0.5)), zero for tokens in half
of the documents or more; those have no postings. A rest is indexed, and asks, with the
counts of its whole document.

Defined cases: a null or empty text is the end id alone; repeated documents are packed as
often as they occur; null ids stay null; ties of score go by shard, id, start and checksum (with ``every`` by
shard and place); an empty table gives no rows; other columns of the input do not matter. Without a document that
may ask, rests stand as they come; a null id does not ask.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import released, written
from tidemart.llm import tokens
from tidemart.llm.tokens import encoder, vocabulary_path

WINDOW, END_ID = 4096, 2
SHARD_TOKENS = 1 << 20
#: Windows a chain fills, about; chains at once; seeds in one row of offers.
CHAIN_WINDOWS, MOST_CHAINS, BLOCK = 8, 20_000, 256
K1, B = 1.2, 0.75
#: Documents whose id it divides are the queries of op4 and of the pipeline.
QUERY_EVERY = 50
#: Texts encoded at once for them, which bounds what the encoder's arrays take.
ENCODED_ROWS = 1000
#: With ``every``: documents of a shard, its tokens that get a dense row, queries of one job, what a query is offered.
SHARD_DOCS, DENSE, QUERIES, REACH = 4096, 2048, 1 << 14, 2
#: What a posting costs, in multiplications of the product of matrices.
POSTING_COST = 400
SHARDS = "shard long, doc_id array<long>, start binary, length binary, doc_tokens binary, sizes binary, ids binary"
OFFERS = "query long, key long, length int, score float, offered boolean"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES = [c.split()[0] for c in PIECES.split(", ")]


def encoded(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 16-bit integers, or 32-bit ones for a larger vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u2" if encoder(vocabulary).size <= 1 << 16 else "<u4"
        end = np.array([end_id], kind).tobytes()
        for batch, coded in tokens.encoded(batches, vocabulary):
            ids = [c.astype(kind).tobytes() + end for c in coded]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def frequencies(ids: DataFrame, size: int, texts: Callable[[pa.RecordBatch], Iterable[np.ndarray]] | None = None) -> tuple[np.ndarray, int, int]:
    """Documents per token id, documents, tokens; each task gives its own sums. ``texts`` reads batches other than of one document a row."""
    kind = "<u2" if size <= 1 << 16 else "<u4"
    read = texts or (lambda batch: (np.frombuffer(coded, kind) for coded in batch.column(0).to_pylist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs, tokens = np.zeros(size, np.int64), 0, 0
        last = np.zeros(size, np.int64)
        for batch in batches:
            for found in read(batch):
                docs, tokens = docs + 1, tokens + len(found)
                place = np.arange(len(found))
                last[found] = place
                counts[found[last[found] == place]] += 1  # one place of each different token
        some = np.flatnonzero(counts)
        keys, values = np.concatenate([some, [-1, -2]]), np.concatenate([counts[some], [docs, tokens]])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.int64())], names=["key", "n"])

    rows = (ids if texts else ids.select("ids")).mapInArrow(lambda batches: released(run(batches)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    totals = {-1: 0, -2: 0}
    for row in rows:
        if row["key"] < 0:
            totals[row["key"]] = row["n"]
        else:
            counts[row["key"]] = row["n"]
    return counts, totals[-1], totals[-2]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _spread(number: int) -> int:
    return (number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 20


def full_windows(ids: DataFrame, size: int, window: int) -> DataFrame:
    """The pieces that are whole windows."""
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 1 << 62 | TaskContext.get().partitionId() << 32
        for batch in batches:
            rows: list[tuple] = []
            for doc, coded in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(coded, kind)
                for at in range(0, len(found) // window * window, window):
                    rows.append((doc, at, window, checksum(found[at:at + window]), len(found), number, 0))
                    number += 1
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_PIECES)

    return ids.mapInArrow(run, PIECES)


def dealt(ids: DataFrame, shards: int, size: int, window: int) -> DataFrame:
    """One row per shard with its rests, packed."""
    kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows: list[tuple] = []
            for doc, coded in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(coded, kind)
                number += 1
                full = len(found) // window * window
                rest = found[full:]
                if len(rest):
                    rows.append((_spread(number) % shards, doc, full, len(rest), checksum(rest), len(found), coded))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[
                "shard", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    def gathered(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        coded = group["ids"].to_pylist()
        numbers = {c: group[c].to_numpy().astype("<i8").tobytes() for c in ("start", "length", "doc_tokens")}
        return pa.table({
            "shard": group["shard"].slice(0, 1), "doc_id": pa.array([group["doc_id"].to_pylist()], pa.list_(pa.int64())),
            **{c: pa.array([raw], pa.binary()) for c, raw in numbers.items()},
            "sizes": pa.array([np.array([len(c) // kind.itemsize for c in coded], "<i8").tobytes()], pa.binary()),
            "ids": pa.array([b"".join(coded)], pa.binary()),
        })

    rests = ids.mapInArrow(
        run, "shard long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    return rests.groupBy("shard").applyInArrow(gathered, SHARDS)


class Shard:
    """The rests of a row of ``dealt``."""

    def __init__(self, row: dict, kind: str):
        self.number, self.doc_id = row["shard"], row["doc_id"]
        self.start, self.length, self.doc_tokens, sizes = (
            np.frombuffer(row[c], "<i8") for c in ("start", "length", "doc_tokens", "sizes"))
        self.texts = np.split(np.frombuffer(row["ids"], kind), np.cumsum(sizes)[:-1])

    def piece(self, place: int, first: int, n: int, sequence: int, offset: int) -> tuple:
        """A row of ``PIECES``; a text ends with its rest."""
        text = self.texts[place]
        at = len(text) - int(self.length[place]) + first
        return (self.doc_id[place], int(self.start[place]) + first, n, checksum(text[at:at + n]),
                int(self.doc_tokens[place]), sequence, offset)


class InvertedIndex:
    """BM25 weights of a shard's texts, by token."""

    def __init__(self, texts: list[np.ndarray], lengths: np.ndarray, idf: np.ndarray, mean_length: float):
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        tokens = np.concatenate(texts)
        known = np.flatnonzero(idf[tokens] > 0)
        known = known[np.argsort(tokens[known], kind="stable")]  # by token, then by text; a radix sort for ids of 16 bits
        token, doc = tokens[known].astype(np.int64), doc[known]
        first = np.flatnonzero(np.append(True, (np.diff(token) != 0) | (np.diff(doc) != 0))[:len(token)])
        tf = np.diff(np.append(first, len(token)))
        self.size, self.doc, token = len(texts), doc[first], token[first]
        norm = K1 * (1 - B + B * lengths[self.doc] / mean_length)
        self.weight = idf[token] * tf * (K1 + 1) / (tf + norm)
        self.tokens, self.at = np.unique(token, return_index=True)
        self.count = np.diff(np.append(self.at, len(token)))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The score of every text for a query's distinct tokens."""
        wanted = np.unique(query)
        place = np.searchsorted(self.tokens, wanted)
        place, wanted = place[place < len(self.tokens)], wanted[place < len(self.tokens)]
        place = place[self.tokens[place] == wanted]
        n = self.count[place]
        if not n.sum():
            return np.zeros(self.size)
        postings = np.repeat(self.at[place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(self.doc[postings], weights=self.weight[postings], minlength=self.size)


def fill(texts: list[np.ndarray], index: InvertedIndex, window: int, lengths: np.ndarray | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of (text, first id, ids): a seed and its unused neighbours, best first; texts may have only ``lengths`` ids to place."""
    left = np.ones(len(texts), bool)
    n = np.array([len(t) for t in texts]) if lengths is None else lengths
    seed, first, following = None, 0, 0
    while True:
        while seed is None and following < len(texts):
            if left[following]:
                seed, first = following, 0
            following += 1
        if seed is None:
            return
        left[seed] = False
        pieces, space = [(seed, first, int(n[seed]) - first)], window - (int(n[seed]) - first)
        query, seed = texts[seed], None
        if space and left.any():
            unused = np.flatnonzero(left)
            best = unused[np.argsort(-index.scores(query)[unused], kind="stable")]
            upto = np.searchsorted(np.cumsum(n[best]), space, side="right")
            for d in best[:upto].tolist():
                left[d] = False
                pieces.append((d, 0, int(n[d])))
                space -= int(n[d])
            if space and upto < len(best):
                seed, first = int(best[upto]), space
                left[seed] = False
                pieces.append((seed, 0, space))
        yield pieces


def _upto(score: np.ndarray, length: np.ndarray, key: np.ndarray, reach: int) -> np.ndarray:
    """Places of the best by score, then key, until their lengths reach ``reach``."""
    best = np.lexsort((key, -score))
    return best[:np.searchsorted(np.cumsum(length[best]), reach) + 1]


def offers(shards: DataFrame, queries: list[np.ndarray], left: dict[int, np.ndarray], idf: np.ndarray, mean: float,
           kind: str, reach: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per query the best unused rests of all shards, best first, until they hold ``reach`` ids: (query, keys, scores).

    A key is the shard's number times 2**32 and the place in it. Each shard gives its own best up to
    ``reach``, which hold all that can be among the best of all shards.
    """
    context = shards.sparkSession.sparkContext
    shared = context.broadcast((queries, left, idf, mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, left, idf, mean = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                part = Shard(row, kind)
                free = np.flatnonzero(left[part.number])
                if not len(free):
                    continue
                index = InvertedIndex([part.texts[k] for k in free.tolist()], part.doc_tokens[free], idf, mean)
                length, keys = part.length[free], (part.number << 32) + free
                for block in range(0, len(queries), BLOCK):
                    found = []
                    for q, query in enumerate(queries[block:block + BLOCK], block):
                        score = index.scores(query)
                        best = _upto(score, length, keys, reach)
                        found.append((np.full(len(best), q), keys[best], length[best], score[best]))
                    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64())] + [pa.array([c.tobytes()], pa.binary()) for c in columns],
                        names=["block", "query", "key", "length", "score"])

    def merged(group: pa.Table) -> pa.Table:
        query, key, length, score = (
            np.concatenate([np.frombuffer(raw, t) for raw in group[c].to_pylist()])
            for c, t in (("query", "<i8"), ("key", "<i8"), ("length", "<i8"), ("score", "<f8")))
        order = np.argsort(query, kind="stable")
        borders = np.flatnonzero(np.diff(query[order])) + 1
        kept = np.concatenate([at[_upto(score[at], length[at], key[at], reach)] for at in np.split(order, borders)])
        return pa.table({"query": [query[kept].tobytes()], "key": [key[kept].tobytes()], "score": [score[kept].tobytes()]})

    found = shards.mapInArrow(run, "block long, query binary, key binary, length binary, score binary")
    rows = found.groupBy("block").applyInArrow(merged, "query binary, key binary, score binary").collect()
    shared.destroy()
    out = []
    for row in rows:
        query, key, score = (np.frombuffer(row[c], t) for c, t in (("query", "<i8"), ("key", "<i8"), ("score", "<f8")))
        for at in np.split(np.arange(len(query)), np.flatnonzero(np.diff(query)) + 1):
            out.append((int(query[at[0]]), key[at], score[at]))
    return sorted(out, key=lambda found: found[0])


def _texts(shards: DataFrame, keys: list[int], kind: str) -> dict[int, np.ndarray]:
    """Different ids of the texts of some rests."""
    wanted: dict[int, list[int]] = {}
    for key in keys:
        wanted.setdefault(key >> 32, []).append(key & 0xFFFFFFFF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = wanted.get(row["shard"], [])
                if places:
                    texts = Shard(row, kind).texts
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["shard"] << 32 | k for k in places], pa.int64()),
                        pa.array([np.unique(texts[k]).tobytes() for k in places], pa.binary())], names=["key", "ids"])

    rows = shards.filter(F.col("shard").isin(list(wanted))).mapInArrow(run, "key long, ids binary").collect()
    return {r["key"]: np.frombuffer(r["ids"], kind) for r in rows}


def chained(shards: DataFrame, lengths: dict[int, np.ndarray], idf: np.ndarray, mean: float, kind: str,
            window: int) -> np.ndarray:
    """Windows by chains side by side: rows of (shard, place, first id, ids, sequence, offset)."""
    left = {s: np.ones(len(n), bool) for s, n in lengths.items()}
    unused = sum(map(len, lengths.values()))
    chains = min(max(1, sum(int(n.sum()) for n in lengths.values()) // window // CHAIN_WINDOWS), MOST_CHAINS)
    waiting = (s << 32 | k for k in range(max(map(len, lengths.values()))) for s in sorted(lengths) if k < len(lengths[s]))
    seeds: list[int | None] = [None] * chains
    texts: dict[int, np.ndarray] = {}
    held: list[list[tuple[int, int, int]]] = [[] for _ in range(chains)]
    space, sequence = [window] * chains, 0
    out: list[np.ndarray] = []

    def emit(pieces: list[tuple[int, int, int]]) -> None:
        nonlocal sequence
        rows = np.array(pieces, np.int64)
        offset = np.cumsum(rows[:, 2]) - rows[:, 2]
        out.append(np.column_stack([
            rows[:, 0] >> 32, rows[:, 0] & 0xFFFFFFFF, rows[:, 1:], np.full(len(rows), sequence), offset]))
        sequence += 1

    while True:
        for c in range(chains):
            if seeds[c] is None:
                key = next((k for k in waiting if left[k >> 32][k & 0xFFFFFFFF]), None)
                if key is None:
                    break
                n = int(lengths[key >> 32][key & 0xFFFFFFFF])
                left[key >> 32][key & 0xFFFFFFFF], unused = False, unused - 1
                seeds[c], held[c], space[c] = key, [(key, 0, n)], window - n
        if not unused:
            break
        asking = [c for c in range(chains) if seeds[c] is not None]
        new = [seeds[c] for c in asking if seeds[c] not in texts]
        texts = {k: texts[k] for k in (seeds[c] for c in asking) if k in texts} | (_texts(shards, new, kind) if new else {})
        found = offers(shards, [texts[seeds[c]] for c in asking], left, idf, mean, kind, 2 * window)
        query = np.concatenate([np.full(len(k), q) for q, k, _ in found])
        key, score = (np.concatenate([f[i] for f in found]) for i in (1, 2))
        closed: set[int] = set()
        order = np.lexsort((key, query, -score))
        for q, k in zip(query[order].tolist(), key[order].tolist(), strict=True):
            c, s, place = asking[q], k >> 32, k & 0xFFFFFFFF
            if c in closed or not left[s][place]:
                continue
            left[s][place], unused = False, unused - 1
            n = int(lengths[s][place])
            first = min(n, space[c])
            held[c].append((k, 0, first))
            space[c] -= first
            if not space[c]:
                emit(held[c])
                closed.add(c)
                cut = first < n
                seeds[c], held[c], space[c] = (k, [(k, first, n - first)], window - n + first) if cut else (None, [], window)
    pieces, room = [], window
    for key, first, n in (p for pieces in held for p in pieces):
        while n:
            here = min(n, room)
            pieces.append((key, first, here))
            first, n, room = first + here, n - here, room - here
            if not room:
                emit(pieces)
                pieces, room = [], window
    if pieces:
        emit(pieces)
    return np.concatenate(out)


def shards_in_place(docs: DataFrame, vocabulary: str, window: int, shard_tokens: int) -> DataFrame:
    """Shards of documents as they come, without a shuffle; documents without a rest are in them, too. The ids are compressed."""

    def shard(number: int, held: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
        sizes = np.array([len(c) for _, c in held], "<i8")
        ids = b"".join(c.tobytes() for _, c in held)
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
            *(pa.array([n.tobytes()], pa.binary()) for n in (sizes // window * window, sizes % window, sizes, sizes)),
            pa.array([pa.Codec("zstd").compress(ids, asbytes=True)], pa.binary())], names=[c.split()[0] for c in SHARDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u2" if encoder(vocabulary).size <= 1 << 16 else "<u4"
        number, held, n = TaskContext.get().partitionId() << 16, [], 0
        some = (batch.slice(at, ENCODED_ROWS) for batch in batches for at in range(0, batch.num_rows, ENCODED_ROWS))
        for batch, coded in tokens.encoded(some, vocabulary):
            for doc, ids in zip(batch.column(0).to_pylist(), coded, strict=True):
                if held and (n + len(ids) > shard_tokens or len(held) == SHARD_DOCS):
                    yield shard(number, held)
                    number, held, n = number + 1, [], 0
                held.append((doc, np.append(ids, END_ID).astype(kind)))
                n += len(ids) + 1
        if held:
            yield shard(number, held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda batches: released(run(batches)), SHARDS)


def _inflated(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[Shard]:
    for batch in batches:
        for row in batch.to_pylist():
            whole = int(np.frombuffer(row["sizes"], "<i8").sum()) * np.dtype(kind).itemsize
            yield Shard(row | {"ids": pa.Codec("zstd").decompress(row["ids"], whole, asbytes=True)}, kind)


class DenseIndex:
    """Scores of many queries at once: a product of matrices for the shard's frequent tokens, postings for the others.

    How many tokens count as frequent depends on the queries: for a token that few of them hold its postings
    are cheaper than a row of the product.
    """

    def __init__(self, index: InvertedIndex):
        self.index = index
        frequent = np.argsort(-index.count, kind="stable")[:DENSE]
        self.row = np.full(len(index.tokens), len(frequent))
        self.row[frequent] = np.arange(len(frequent))
        row = np.repeat(self.row, index.count)
        dense = row < len(frequent)
        self.table = np.zeros((len(frequent), index.size), np.float32)
        self.table[row[dense], index.doc[dense]] = index.weight[dense]
        self.place = np.full(int(index.tokens[-1]) + 2 if len(index.tokens) else 1, -1)  # the last stands for all greater tokens
        self.place[index.tokens] = np.arange(len(index.tokens))

    def rows(self, row: np.ndarray, postings: np.ndarray, n: int) -> int:
        """For how many of the most frequent tokens the product is worth it; ``row`` and ``postings`` of each pair of a query and a token."""
        most = len(self.table)
        by_row = np.bincount(row, weights=postings, minlength=most + 1)
        beyond = by_row.sum() - np.concatenate([[0], np.cumsum(by_row[:most])])
        return int(np.argmin(np.arange(most + 1) * (n * self.index.size) + beyond * POSTING_COST))

    def scores(self, query: np.ndarray, token: np.ndarray, n: int) -> np.ndarray:
        """The score of every text for ``n`` queries, given as pairs of a query's number and one of its distinct tokens."""
        index, size = self.index, self.index.size
        place = self.place[np.minimum(token, len(self.place) - 1)]
        known = np.flatnonzero(place >= 0)
        query, place = query[known], place[known]
        row = self.row[place]
        rows = self.rows(row, index.count[place], n)
        dense = row < rows
        wanted = np.zeros((n, rows), np.float32)
        wanted[query[dense], row[dense]] = 1
        out = wanted @ self.table[:rows]
        query, place = query[~dense], place[~dense]
        if len(place):
            at, count = index.at[place], index.count[place]
            cell = np.repeat(query * size, count) + tokens.slices(index.doc, at, count)
            out += np.bincount(cell, weights=tokens.slices(index.weight, at, count), minlength=n * size).reshape(n, size)
        return out


class Best:
    """Of some queries what they are offered: the best of all rests added, until they hold ``reach`` ids."""

    def __init__(self, queries: int, reach: int):
        self.reach, self.least = reach, np.full(queries, -np.inf, np.float32)
        self.kept = [np.empty(0, t) for t in (np.int64, np.int64, np.int32, np.float32)]  # query, key, length, score
        self.new: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, keys: np.ndarray, length: np.ndarray) -> None:
        """The scores of each query with some rests."""
        if np.isneginf(self.least).all():
            order = np.argsort(-scores, axis=1, kind="stable")
            n = length[order].astype(np.int64)
            query, rank = np.nonzero(n.cumsum(axis=1) - n < self.reach)
            rest = order[query, rank]
        else:
            query, rest = np.nonzero(scores >= self.least[:, None])
        self.new.append([query, keys[rest], length[rest], scores[query, rest]])
        self.waiting += len(query)
        if 2 * self.waiting > len(self.kept[0]):
            self.merge()

    def merge(self) -> None:
        query, key, length, score = (np.concatenate(c) for c in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((key, -score, query))
        query, key, length, score = query[order], key[order], length[order], score[order]
        before = np.cumsum(length, dtype=np.int64) - length
        first = np.searchsorted(query, query)
        before -= before[first]
        keep = before < self.reach
        full = keep & (before + length >= self.reach)
        self.least[query[full]] = score[full]
        self.kept, self.new, self.waiting = [query[keep], key[keep], length[keep], score[keep]], [], 0


def asked(shards: DataFrame, keys: np.ndarray, texts: list[np.ndarray], idf: np.ndarray, mean: float, kind: str, reach: int) -> DataFrame:
    """``OFFERS``: what each query is offered by the shards of a task, and for each rest the query it scores highest with (not offered).

    A query is offered its own rest before all others. Scores are of single precision.
    """
    spark = shards.sparkSession
    shared = spark.sparkContext.broadcast((keys, texts, idf, mean))
    names = [c.split()[0] for c in OFFERS.split(", ")]

    def rows(query: np.ndarray, key: np.ndarray, length: np.ndarray, score: np.ndarray, offered: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(query, pa.int64()), pa.array(key, pa.int64()), pa.array(length.astype(np.int32)), pa.array(score.astype(np.float32)),
            pa.array(np.full(len(key), offered))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking, texts, idf, mean = shared.value
        blocks = []
        for at in range(0, len(asking), BLOCK):
            some = texts[at:at + BLOCK]
            blocks.append((np.repeat(np.arange(len(some)), [len(t) for t in some]), np.concatenate(some).astype(np.int64), Best(len(some), reach)))
        for part in _inflated(batches, kind):
            held = np.flatnonzero(part.length)
            if not len(held):
                continue
            index = DenseIndex(InvertedIndex([part.texts[k] for k in held.tolist()], part.doc_tokens[held], idf, mean))
            key, length = (part.number << 32) + held, part.length[held].astype(np.int32)
            score, query = np.full(len(held), -1, np.float32), np.full(len(held), -1)
            for number, (of, token, best) in enumerate(blocks):
                n, at = len(best.least), number * BLOCK
                found = index.scores(of, token, n)
                place = np.searchsorted(key, asking[at:at + n])
                own = np.flatnonzero(key[np.minimum(place, len(key) - 1)] == asking[at:at + n])
                found[own, place[own]] = np.inf
                best.add(found, key, length)
                highest = found.argmax(axis=0)
                higher = found[highest, np.arange(len(key))] > score
                score[higher] = found[highest[higher], higher]
                query[higher] = asking[at + highest[higher]]
            yield rows(query, key, length, score, False)
        for number, (_, _, best) in enumerate(blocks):
            best.merge()
            query, key, length, score = best.kept
            yield rows(asking[number * BLOCK + query], key, length, score, True)

    return shards.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(lambda batches: released(run(batches)), OFFERS)


def chosen(offers: DataFrame, reach: int) -> DataFrame:
    """(query, key, length, score): each rest once, at the query that gets it."""
    best = F.max(F.struct("score", (-F.col("query")).alias("negative"), "length"))
    before = F.sum("length").over(
        Window.partitionBy("query").orderBy(F.col("score").desc(), "key").rowsBetween(Window.unboundedPreceding, -1))
    among = offers.filter("offered").withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < reach)
    wanted = among.groupBy("key").agg(best.alias("wanted"))
    nearest = offers.filter("not offered").groupBy("key").agg(best.alias("nearest"))
    found = nearest.join(wanted, "key", "left").select("key", F.coalesce("wanted", "nearest").alias("b"))
    return found.select((-F.col("b.negative")).alias("query"), "key", "b.length", "b.score")


def in_a_row(picked: DataFrame, partitions: int) -> DataFrame:
    """(key, position): the ids before each rest, all rests in a row by query and falling score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy().astype(np.int64)
            after = before + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n), pa.array(after - n), pa.array(np.full(len(n), part))], names=["key", "length", "before", "part"])
            before = int(after[-1]) if len(n) else before

    ordered = picked.repartitionByRange(partitions, "query", F.col("score").desc(), "key").sortWithinPartitions(
        "query", F.col("score").desc(), "key")
    held = written(ordered.select("key", "length").mapInArrow(run, "key long, length long, before long, part long"), "rows")
    totals = sorted(held.groupBy("part").agg(F.sum("length").alias("n")).collect(), key=lambda r: r["part"])
    borders = np.concatenate([[0], np.cumsum([r["n"] for r in totals])]).tolist()
    starts = picked.sparkSession.createDataFrame([(r["part"], b) for r, b in zip(totals, borders)], "part long, start long")
    return held.join(starts, "part").select("key", (F.col("start") + F.col("before")).alias("position"))


def pack_by_queries(docs: DataFrame, vocabulary: str, window: int, shard_tokens: int, every: int) -> DataFrame:
    """Pieces in windows of the documents whose id ``every`` divides."""
    size = encoder(vocabulary).size
    kind = "<u2" if size <= 1 << 16 else "<u4"
    spark = docs.sparkSession
    shards = written(shards_in_place(docs, vocabulary, window, shard_tokens), "shards")
    counts, n_docs, n_tokens = frequencies(shards, size, lambda batch: (t for part in _inflated([batch], kind) for t in part.texts))
    if not n_docs:
        return spark.createDataFrame([], PIECES)
    idf, mean = np.maximum(np.log((n_docs - counts + 0.5) / (counts + 0.5)), 0.0), n_tokens / n_docs

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _inflated(batches, kind):
            places = [k for k, d in enumerate(part.doc_id) if d is not None and d % every == 0 and part.length[k]]
            yield pa.RecordBatch.from_arrays([
                pa.array([part.number << 32 | k for k in places], pa.int64()),
                pa.array([np.unique(part.texts[k]).tobytes() for k in places], pa.binary())], names=["key", "ids"])

    queries = written(shards.mapInArrow(asking, "key long, ids binary"), "queries")
    keys = np.sort(np.array([r["key"] for r in queries.select("key").collect()], np.int64))
    reach = REACH * -(-n_tokens // max(len(keys), 1))
    offers = None
    for at in range(0, max(len(keys), 1), QUERIES):
        some = keys[at:at + QUERIES]
        rows = queries.filter(F.col("key").between(int(some[0]), int(some[-1]))).collect() if len(some) else []
        texts = [np.frombuffer(r["ids"], kind) for r in sorted(rows, key=lambda r: r["key"])]
        found = asked(shards, some, texts, idf, mean, kind, reach)
        found = written(found, "offers")
        offers = found if offers is None else offers.unionAll(found)
    picked = written(chosen(offers, reach), "chosen")
    placed = in_a_row(picked, 2 * spark.sparkContext.defaultParallelism)
    placed = placed.withColumn("shard", F.shiftright("key", 32))

    def cut(group: pa.Table, row: pa.Table) -> pa.Table:
        out = []
        for part in _inflated(row.to_batches(), kind):
            position = dict(zip((group["key"].to_numpy() & 0xFFFFFFFF).tolist(), group["position"].to_pylist(), strict=True))
            full = 1 << 62 | part.number << 32
            for place, text in enumerate(part.texts):
                for at in range(0, int(part.start[place]), window):
                    out.append((part.doc_id[place], at, window, checksum(text[at:at + window]), len(text), full, 0))
                    full += 1
                first, n = 0, int(part.length[place])
                while first < n:
                    sequence, offset = divmod(position[place] + first, window)
                    here = min(n - first, window - offset)
                    out.append(part.piece(place, first, here, sequence, offset))
                    first += here
        return pa.Table.from_batches([_batch(out)])

    return placed.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(cut, PIECES)


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS,
         every: int | None = None) -> DataFrame:
    """Pieces of documents with their places in sequences; with ``every`` only documents whose id it divides ask."""
    vocabulary = vocabulary or vocabulary_path()
    if every:
        return pack_by_queries(docs, vocabulary, window, shard_tokens, every)
    size = encoder(vocabulary).size
    kind = "<u2" if size <= 1 << 16 else "<u4"
    ids = written(encoded(docs, vocabulary), "token-ids")
    counts, n_docs, n_tokens = frequencies(ids, size)
    idf, mean = np.maximum(np.log((n_docs - counts + 0.5) / (counts + 0.5)), 0.0), n_tokens / max(n_docs, 1)
    shards = written(dealt(ids, max(1, -(-n_tokens // shard_tokens)), size, window), "rests")
    lengths = {r["shard"]: np.frombuffer(r["length"], "<i8").astype(np.int32) for r in shards.select("shard", "length").collect()}
    full = full_windows(ids, size, window)
    if not lengths:
        return full
    if len(lengths) == 1:
        shared = docs.sparkSession.sparkContext.broadcast((idf, mean))

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    part = Shard(row, kind)
                    index = InvertedIndex(part.texts, part.doc_tokens, *shared.value)
                    out = []
                    for sequence, pieces in enumerate(fill(part.texts, index, window, part.length)):
                        offset = 0
                        for place, first, n in pieces:
                            out.append(part.piece(place, first, n, sequence, offset))
                            offset += n
                    yield _batch(out)

        return full.unionAll(shards.mapInArrow(packed, PIECES))
    plan = chained(shards, lengths, idf, mean, kind, window)
    names = ["shard", "place", "first", "n", "sequence", "offset"]
    placed = docs.sparkSession.createDataFrame(pa.table({c: plan[:, i] for i, c in enumerate(names)}))

    def cut(group: pa.Table, row: pa.Table) -> pa.Table:
        part = Shard(row.to_pylist()[0], kind)
        columns = (group[c].to_pylist() for c in names[1:])
        return pa.Table.from_batches([_batch([part.piece(*p) for p in zip(*columns, strict=True)])])

    return full.unionAll(placed.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(cut, PIECES))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_PIECES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_PIECES)
