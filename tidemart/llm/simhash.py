"""SimHash near-duplicates: vantage-point trees shard the fingerprints, exact pairs come from the shards.

Two fingerprints within ``radius`` bits differ in at most ``radius // blocks`` bits of at
least one of ``blocks`` disjoint bit ranges. Over each range a vantage-point tree, grown on a bounded
sample, splits the Hamming space: at each node the distance to a vantage point decides the
side. Every fingerprint has one home leaf in each tree. By the triangle inequality a partner
of x within r bits lies on the inner side only if d(x, v) - r <= m and on the outer side
only if d(x, v) + r > m; x also visits every later leaf that its ball reaches, and a leaf compares its
residents, in all 64 bits, with each other and with its visitors. So each linked pair meets in
one leaf of some tree, and none is lost.

With one tree over all 64 bits (``blocks=1``) almost every bound lies within the radius of
most points, and the visits grow as the input to the power 1.6. Four trees with a radius of one bit
bound them: a ball holds 17 points of a 16-bit range, so 68 rows per fingerprint at most.

Equal fingerprints are one class before the tree, so copies cost one row. A leaf gives
a spanning forest of its links, not all pairs. Classes are joined by alternating
large-star and small-star steps, each a written table.

Only the sample (``SAMPLE_PER_LEAF`` fingerprints per leaf, ``MAX_SAMPLE`` at most) and
the tree reach the driver; every fingerprint is assigned and compared.

Defined cases: a null or wordless text has fingerprint zero and links like any other;
a text of fewer than four words is one shingle; repeated documents each get their row;
a null id is ignored in the minimum, and a component of null ids alone has a null
component; an empty table gives no rows; columns named as the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import append_columns, field, raw_texts, written

SHINGLE = 4
RADIUS = 4
SEED = 42
LEAF_SIZE = 4096
BLOCKS = 4
SAMPLE_PER_LEAF, MAX_SAMPLE = 64, 200_000
#: Cells of one block of the distance matrix in a leaf.
BLOCK_CELLS = 1 << 21

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words, repeats included."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts = np.concatenate([[0], ends[:-size] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist(), strict=True)), np.uint64, n
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``fp``: the fingerprint's 64 bits as a (signed) long."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        values = np.array([fingerprint(shingle_hashes(t)) for t in raw_texts(batch, text_col)], np.uint64)
        return [pa.array(values.view(np.int64))]

    return append_columns(docs, [field("fp", T.LongType())], lambda: compute)


class VantageTree:
    """A vantage-point tree over fixed-width bit strings under Hamming distance."""

    def __init__(self, sample: np.ndarray, leaves: int, radius: int, seed: int = SEED):
        self.radius = radius
        self.vantage: list[int] = []
        self.bound: list[int] = []
        self.inner: list[int] = []
        self.outer: list[int] = []
        self.leaves = 0
        self._random = np.random.default_rng(seed)
        self._grow(sample, leaves)

    def _grow(self, sample: np.ndarray, leaves: int) -> int:
        node = len(self.vantage)
        for column, value in ((self.vantage, 0), (self.bound, -1), (self.inner, -1), (self.outer, -1)):
            column.append(value)
        split = self._split(sample) if leaves > 1 and len(sample) > 1 else None
        if split is None:
            self.inner[node] = -1 - self.leaves  # a leaf holds its number, negated
            self.leaves += 1
            return node
        self.vantage[node], self.bound[node] = split
        inside = np.bitwise_count(sample ^ np.uint64(split[0])) <= split[1]
        within = min(leaves - 1, max(1, round(leaves * inside.mean())))
        self.inner[node] = self._grow(sample[inside], within)
        self.outer[node] = self._grow(sample[~inside], leaves - within)
        return node

    def _split(self, sample: np.ndarray) -> tuple[int, int] | None:
        """Of a few vantage points and bounds those with the fewest crossings for what they part."""
        best = None
        for vantage in self._random.choice(sample, min(24, len(sample)), replace=False):
            share = np.bincount(np.bitwise_count(sample ^ vantage), minlength=80) / len(sample)
            upto = np.cumsum(share)
            for bound in range(64):
                p = upto[bound]
                if 0.2 <= p <= 0.8:
                    crossing = upto[bound + self.radius]
                    crossing -= upto[bound - self.radius] if bound >= self.radius else 0.0
                    cost = (np.log2(1 + crossing) + 0.01) / -(p * np.log2(p) + (1 - p) * np.log2(1 - p))
                    if best is None or cost < best[0]:
                        best = (cost, int(vantage), bound)
        return best and best[1:]

    def places(self, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, residents, visitors) as positions; a visitor's home is an earlier leaf and its ball reaches this one."""
        yield from self._place(0, values, np.arange(len(values)), np.zeros(0, np.int64))

    def _place(self, node: int, values: np.ndarray, home: np.ndarray, visit: np.ndarray):
        if self.bound[node] < 0:
            yield -1 - self.inner[node], home, visit
            return
        vantage, bound, radius = np.uint64(self.vantage[node]), self.bound[node], self.radius
        dh = np.bitwise_count(values[home] ^ vantage).astype(np.int16)
        dv = np.bitwise_count(values[visit] ^ vantage).astype(np.int16)
        yield from self._place(self.inner[node], values, home[dh <= bound], visit[dv - radius <= bound])
        # Residents of the inner side visit the outer one; it comes later, so no pair meets twice in a tree.
        crossing = home[(dh <= bound) & (dh + radius > bound)]
        yield from self._place(
            self.outer[node], values, home[dh > bound], np.concatenate([visit[dv + radius > bound], crossing])
        )


def block(values: np.ndarray, number: int, blocks: int) -> np.ndarray:
    """One of ``blocks`` disjoint bit ranges of fingerprints."""
    first, end = 64 * number // blocks, 64 * (number + 1) // blocks
    return (values >> np.uint64(first)) & np.uint64((1 << (end - first)) - 1)


def forest(home: np.ndarray, visit: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges (index, root index) of a spanning forest over the pairs within ``radius`` that have a resident."""
    every = np.concatenate([home, visit])
    parent = np.arange(len(every))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    rows = max(1, BLOCK_CELLS // max(1, len(every)))
    for at in range(0, len(home), rows):
        near = np.bitwise_count(home[at:at + rows, None] ^ every[None, at:]) <= radius
        for k in np.flatnonzero(near.sum(axis=1) > 1):
            found = np.flatnonzero(near[k]) + at
            tops = parent[found]
            while (parent[tops] != tops).any():
                tops = parent[tops]
            parent[found] = tops
            tops = np.unique(tops)
            parent[tops] = tops[0]
    return [(i, root(i)) for i in np.flatnonzero(parent != np.arange(len(every)))]


def links(classes: DataFrame, radius: int = RADIUS, leaf_size: int = LEAF_SIZE, blocks: int = BLOCKS) -> DataFrame:
    """(a, b) long: a forest per leaf over distinct fingerprints ``fp`` within ``radius`` bits."""
    spark = classes.sparkSession
    n = classes.count()
    leaves = max(1, -(-n // leaf_size))
    wanted = min(MAX_SAMPLE, leaves * SAMPLE_PER_LEAF)
    by_hash = F.xxhash64("fp")
    share = classes if n <= wanted else classes.filter(
        F.pmod(by_hash, F.lit(1 << 30)) < F.lit(int(1.5 * wanted / n * (1 << 30)) + 1)
    )
    sample = np.array([r.fp for r in share.select("fp").limit(2 * wanted).collect()], np.int64).view(np.uint64)
    grown = [VantageTree(block(sample, k, blocks), leaves, radius // blocks) for k in range(blocks)]
    trees = spark.sparkContext.broadcast(grown)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for k, tree in enumerate(trees.value):
                for leaf, home, visit in tree.places(block(values, k, blocks)):
                    for part, resident in ((home, True), (visit, False)):
                        if len(part):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(part), k << 24 | leaf, np.int32)),
                                 pa.array(values[part].view(np.int64)),
                                 pa.array(np.full(len(part), resident))], names=["leaf", "fp", "resident"])

    def pairs(group: pa.Table) -> pa.Table:
        values, resident = group["fp"].to_numpy().view(np.uint64), group["resident"].to_numpy()
        home, visit = np.sort(values[resident]), np.sort(values[~resident])
        every = np.concatenate([home, visit]).view(np.int64)
        found = np.array(forest(home, visit, radius), np.int64).reshape(-1, 2)
        return pa.table({"a": every[found[:, 0]], "b": every[found[:, 1]]})

    placed = classes.select("fp").mapInArrow(shard, "leaf int, fp long, resident boolean")
    return placed.groupBy("leaf").applyInArrow(pairs, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge, its root the least node of its component.

    Large-star links a node's larger neighbours to its least one, small-star the smaller
    ones; both alternate until nothing changes. Each round is a written table.
    """
    def oriented(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()

    current = written(oriented(edges), "links")
    while not current.isEmpty():
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b")
        following = written(oriented(small), "links")
        same = current.exceptAll(following).isEmpty() and following.exceptAll(current).isEmpty()
        current = following
        if same:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _classed(
    docs: DataFrame, id_col: str, text_col: str, radius: int, leaf_size: int, blocks: int, *more: Column,
) -> DataFrame:
    """(doc_id, fp, root, component_id) and ``more`` of each document; a root is one component's own."""
    marked = fingerprints(docs.select(id_col, text_col), text_col).select(F.col(id_col).alias("doc_id"), "fp", *more)
    marked = written(marked, "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, radius, leaf_size, blocks))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(by_class, "fp", "left")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
    leaf_size: int = LEAF_SIZE, blocks: int = BLOCKS,
) -> DataFrame:
    """One row (id, fp, component_id) per document; the component is the least id reachable over links."""
    return _classed(docs, id_col, text_col, radius, leaf_size, blocks).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, radius: int = RADIUS, leaf_size: int = LEAF_SIZE, blocks: int = BLOCKS) -> DataFrame:
    """The documents without near-copies: of each component the row of its least id stays, once.

    Of a component's rows that repeat this id one stays; two components with the same
    least id keep a row each. Rows without an id cannot stand for a group and are kept
    as they are. All columns stay.
    """
    digest = F.xxhash64("text")
    found = _classed(docs.filter("doc_id is not null"), "doc_id", "text", radius, leaf_size, blocks, digest.alias("__text"))
    chosen = found.filter("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "fp", "__text")).alias("__row"))
    chosen = chosen.select(F.col("__row.doc_id").alias("__id"), F.col("__row.__text").alias("__text"))
    marked = docs.withColumn("__digest", digest)
    same = (marked["doc_id"] == chosen["__id"]) & (marked["__digest"] == chosen["__text"])
    named = marked.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "__digest"]).drop("__digest")
    return named.unionByName(docs.filter("doc_id is null"))
