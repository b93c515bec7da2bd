"""Phrases of two and three words by the stripes pattern.

A stripe belongs to a first word and counts the words that follow it, and behind each of
these the words that follow the pair. One structure so holds a prefix's total, its
extensions and the largest count of them, which tells whether a pair is subsumed.

1. Words with a share of the text that would crowd a partition are found first: such a word has
   that share in some task, so each task names its own, a bounded number.
2. Each task numbers the words of about ``FLUSH_BYTES`` of text and builds one packed stripe per
   first word, or, for a frequent one, one per hash of the second word.
3. Stripes go by language, first word and that hash to partitions of about ``PARTITION_BYTES`` of
   text, so no word is one task's work, and are merged element by element as they
   come. Phrases that occur often enough leave the merge, with the largest extension of
   each pair, and all totals of single words.
4. The rest are joins of that small table with itself: the counts of a phrase's parts, the
   largest extension to the left, the scores.

Every count is exact, over whole texts and all rows. Scores are ratios of decimals of 38 digits;
counts may have up to 15.

Defined cases: a null or wordless text counts for nothing; a null language is ``und`` and joins
a language of that name; repeated documents count as often as they occur; an empty table
gives no rows; other columns of the input do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import written
from tidemart.operators.joins import keyed_join

LEAST, TOP = 10, 2000
#: A pair is subsumed by an extension that has at least so many percent of its occurrences.
SUBSUMED_PERCENT = 50
NO_LANGUAGE = "und"
#: Text whose stripes a task builds at once, and text whose stripes a partition merges.
FLUSH_BYTES, PARTITION_BYTES = 4 << 20, 8 << 20
#: Entries that a merging task gathers before it merges them.
MERGE_ENTRIES = 3_000_000
#: Stripes of one Arrow batch.
BATCH_STRIPES = 20_000
#: A word is frequent if it has this part of a partition's share of all words; its stripe has a part per partition.
FREQUENT = 0.25

_BREAK = b"."  # stands for all marks that end a piece; no word holds one
# Second words, and all third words behind them, joined by spaces; counts, and numbers of third words, as 64-bit integers.
_STRIPES = (
    "lang string, first string, shard int, total long, second string, second_n binary, thirds binary, third string, third_n binary"
)
_FOUND = "lang string, first string, second string, third string, n long, longer long"


def _byte_table() -> np.ndarray:
    """Bytes of lower case, with one mark for all breaks and a space for a tab."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    table[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK[0]
    table[0x09] = 0x20
    return table


_TABLE = _byte_table()


def _plain_texts(texts: pa.Array) -> pa.Array:
    """The texts in lower case, pieces parted by a break that is a word of its own."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    raw = pa.concat_arrays([texts])  # without an offset into a larger buffer
    _, offsets, data = raw.buffers()
    changed = _TABLE[np.frombuffer(data, np.uint8)] if data is not None else np.empty(0, np.uint8)
    out = pa.LargeStringArray.from_buffers(len(raw), offsets, pa.py_buffer(changed), None, 0, raw.offset)
    return pc.replace_substring(out, _BREAK.decode(), " . ")


def _grouped(keys: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys in order, number of each key's group, sum of the weights of each group)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    if weight is None:
        sums = np.diff(begin, append=len(keys))
    else:
        sums = np.add.reduceat(weight[order], begin) if len(begin) else np.empty(0, np.int64)
    return ordered[begin], number, sums


class Stripes:
    """Stripes in numbers: rows by (language, first word, shard), pairs by (row, second), triples by (pair, third)."""

    def __init__(self, words: pa.Array, langs: pa.Array, row_key: np.ndarray, shards: int):
        self.words, self.langs, self.shards = words, langs, shards
        self.row_key = row_key
        self.total = np.zeros(0, np.int64)
        self.pair_row = self.second = self.second_n = np.zeros(0, np.int64)
        self.triple_pair = self.third = self.third_n = np.zeros(0, np.int64)

    @classmethod
    def summed(
        cls, words: pa.Array, langs: pa.Array, shards: int,
        rows: tuple[np.ndarray, np.ndarray | None],
        pairs: tuple[np.ndarray, np.ndarray, np.ndarray | None],
        triples: tuple[np.ndarray, np.ndarray, np.ndarray | None],
    ) -> Stripes:
        """From entries that may repeat: rows (key, weight), pairs (entry of rows, second, weight), triples (entry of pairs, third, weight)."""
        size = max(len(words), 1)
        keys, row, total = _grouped(*rows)
        out = cls(words, langs, keys, shards)
        out.total = total
        found, pair, out.second_n = _grouped(row[pairs[0]] * size + pairs[1], pairs[2])
        out.pair_row, out.second = np.divmod(found, size)
        found, _, out.third_n = _grouped(pair[triples[0]] * size + triples[1], triples[2])
        out.triple_pair, out.third = np.divmod(found, size)
        return out

    @property
    def entries(self) -> int:
        return len(self.total) + len(self.second) + len(self.third)

    def _key(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rest, shard = np.divmod(self.row_key, self.shards)
        lang, first = np.divmod(rest, max(len(self.words), 1))
        return lang, first, shard

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One row per stripe, a slice of the rows at a time."""
        lang, first, shard = self._key()
        pairs = np.searchsorted(self.pair_row, np.arange(len(self.total) + 1))
        triples = np.searchsorted(self.triple_pair, np.arange(len(self.second) + 1))
        thirds = np.diff(triples)
        names = [c.split()[0] for c in _STRIPES.split(", ")]

        def joined(words: np.ndarray, at: np.ndarray) -> pa.Array:
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), self.words.take(pa.array(words))), " ")

        def packed(numbers: np.ndarray, at: np.ndarray) -> pa.Array:
            raw = pa.py_buffer(np.ascontiguousarray(numbers, "<i8"))
            return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((8 * at).astype(np.int32)), raw])

        for a in range(0, len(self.total), BATCH_STRIPES):
            b = min(a + BATCH_STRIPES, len(self.total))
            p, q = pairs[a], pairs[b]
            s, t = triples[p], triples[q]
            pair_at, triple_at = pairs[a:b + 1] - p, triples[pairs[a:b + 1]] - s
            yield pa.RecordBatch.from_arrays([
                self.langs.take(pa.array(lang[a:b])), self.words.take(pa.array(first[a:b])),
                pa.array(shard[a:b], pa.int32()), pa.array(self.total[a:b]),
                joined(self.second[p:q], pair_at), packed(self.second_n[p:q], pair_at), packed(thirds[p:q], pair_at),
                joined(self.third[s:t], triple_at), packed(self.third_n[s:t], triple_at),
            ], names=names)

    def found(self, least: int) -> Iterator[pa.RecordBatch]:
        """All totals of first words, and the pairs and triples that occur often enough."""
        lang, first, _ = self._key()
        kept = np.flatnonzero(self.third_n >= least)
        longer = np.zeros(len(self.second), np.int64)
        np.maximum.at(longer, self.triple_pair[kept], self.third_n[kept])
        often = np.flatnonzero(self.second_n >= least)
        none = np.int64(-1)

        def word(number: np.ndarray) -> pa.Array:
            return self.words.take(pa.array(number, mask=number < 0))

        parts = [
            (np.arange(len(self.total)), none, none, self.total, np.int64(0)),
            (self.pair_row[often], self.second[often], none, self.second_n[often], longer[often]),
            (self.pair_row[self.triple_pair[kept]], self.second[self.triple_pair[kept]], self.third[kept], self.third_n[kept], np.int64(0)),
        ]
        for row, second, third, n, most in parts:
            size = len(row)
            for a in range(0, size, BATCH_STRIPES):
                cut = slice(a, min(a + BATCH_STRIPES, size))
                second_, third_, most_ = (np.broadcast_to(x, size)[cut] for x in (second, third, most))
                yield pa.RecordBatch.from_arrays(
                    [self.langs.take(pa.array(lang[row[cut]])), word(first[row[cut]]), word(second_), word(third_),
                     pa.array(n[cut]), pa.array(np.ascontiguousarray(most_))],
                    names=["lang", "first", "second", "third", "n", "longer"])


def numbered_words(texts: pa.Array) -> tuple[pa.Array, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(different words, their bytes, number of each word, whether it is one, words and breaks per text)."""
    parts = pc.ascii_split_whitespace(_plain_texts(texts))
    numbered = pa.concat_arrays([parts.flatten().cast(pa.string())]).dictionary_encode()
    word = numbered.indices.to_numpy()
    different = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    # Breaks, and the empty strings that splitting leaves at either end of a text, are no words.
    plain = np.fromiter((w not in (_BREAK, b"") for w in different), bool, len(different))
    return numbered.dictionary, different, word, plain[word], np.diff(parts.offsets.to_numpy())


def stripes_of(texts: pa.Array, langs: pa.Array, shards: int, frequent: frozenset[bytes] = frozenset()) -> Stripes:
    """The stripes of some documents."""
    words, different, word, is_word, sizes = numbered_words(texts)
    word = word.astype(np.int64)
    langs = pc.fill_null(langs, NO_LANGUAGE).dictionary_encode()
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    lang = langs.indices.to_numpy()[doc].astype(np.int64)
    cut = np.fromiter(map(frequent.__contains__, different), bool, len(different))
    shard = np.fromiter(map(zlib.crc32, different), np.int64, len(different)) % shards

    at = np.flatnonzero(is_word)
    follows = np.zeros(len(word), bool)  # a word of the same piece comes next
    follows[:-1] = (doc[1:] == doc[:-1]) & is_word[1:] & is_word[:-1]
    behind = np.zeros(len(word), np.int64)
    behind[:-1] = np.where(follows[:-1] & cut[word[:-1]], shard[word[1:]], 0)
    rows = (lang[at] * max(len(words), 1) + word[at]) * shards + behind[at]
    row_of = np.cumsum(is_word) - 1  # entry of the rows at each word
    two = np.flatnonzero(follows)
    pair_of = np.cumsum(follows) - 1
    three = two[follows[np.minimum(two + 1, len(word) - 1)]] if len(two) else two
    return Stripes.summed(
        words, langs.dictionary, shards, (rows, None),
        (row_of[two], word[two + 1], None), (pair_of[three], word[three + 2], None))


def merged(parts: list[pa.RecordBatch], shards: int) -> Stripes:
    """Stripes of the same key added element by element."""

    def column(name: str) -> pa.Array:
        return pa.concat_arrays([b.column(b.schema.get_field_index(name)) for b in parts])

    def numbers(name: str) -> tuple[np.ndarray, np.ndarray]:
        """(packed numbers in a row, how many each stripe has)."""
        packed = column(name)
        lengths = pc.binary_length(packed).to_numpy() // 8
        return np.frombuffer(b"".join(packed.to_numpy(zero_copy_only=False).tolist()), "<i8"), lengths

    def words_of(name: str, lengths: np.ndarray) -> pa.Array:
        some = column(name).filter(pa.array(lengths > 0))
        return pc.split_pattern(some, " ").flatten()

    rows = column("first")
    second_n, seconds = numbers("second_n")
    third_n, behind = numbers("third_n")
    thirds, _ = numbers("thirds")
    strings = pa.concat_arrays([rows, words_of("second", seconds), words_of("third", behind)]).dictionary_encode()
    words, number = strings.dictionary, strings.indices.to_numpy().astype(np.int64)
    first, second, third = np.split(number, [len(rows), len(rows) + len(second_n)])
    langs = column("lang").dictionary_encode()
    key = (langs.indices.to_numpy().astype(np.int64) * max(len(words), 1) + first) * shards + column("shard").to_numpy()
    return Stripes.summed(
        words, langs.dictionary, shards, (key, column("total").to_numpy()),
        (np.repeat(np.arange(len(rows)), seconds), second, second_n),
        (np.repeat(np.arange(len(second_n)), thirds), third, third_n))


def _size(batch: pa.RecordBatch) -> int:
    """Entries of packed stripes."""
    bytes_ = sum(pc.sum(pc.binary_length(batch.column(k))).as_py() or 0 for k in (5, 8))
    return batch.num_rows + bytes_ // 8


def frequent_words(texts: DataFrame, share: float) -> frozenset[bytes]:
    """Words that have at least about this share of all words; at most 1 / share of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, different, word, is_word, _ = numbered_words(batch.column(0))
            counts = np.bincount(word[is_word], minlength=len(different))
            total = int(counts.sum())
            often = np.flatnonzero(counts > share * total).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *(different[k].decode() for k in often)], pa.string()),
                 pa.array([total, *counts[often].tolist()], pa.int64())], names=["word", "n"])

    counted = texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = written(counted, "frequent-words")
    total = counted.filter("word IS NULL").first()
    if total is None:
        return frozenset()
    rows = counted.filter((F.col("word").isNotNull()) & (F.col("n") > F.lit(share) * F.lit(total["n"]))).collect()
    return frozenset(row["word"].encode() for row in rows)


def counted(docs: DataFrame, least: int = LEAST, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(lang, first, second, third, n, longer): parts of the totals of single words, and phrases with ``n`` of at least ``least``.

    ``longer`` is the count of a pair's most frequent extension to the right, if often enough.
    """
    texts = docs.select("lang", "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(1, -(-size // partition_bytes))
    frequent = frequent_words(texts, FREQUENT / partitions)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= FLUSH_BYTES:
                yield from _built(held, partitions, frequent)
                held, size = [], 0
        yield from _built(held, partitions, frequent)
        pa.default_memory_pool().release_unused()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, 0
        for batch in batches:
            held.append(batch)
            size += _size(batch)
            if size - known >= max(MERGE_ENTRIES, known):
                whole = merged(held, partitions)
                held, size = list(whole.batches()), whole.entries
                known = size
        if held:
            whole = merged(held, partitions)
            held.clear()
            yield from whole.found(least)
        pa.default_memory_pool().release_unused()

    built = texts.mapInArrow(build, _STRIPES)
    return built.repartition(partitions, "lang", "first", "shard").mapInArrow(merge, _FOUND)


def _built(held: list[pa.RecordBatch], shards: int, frequent: frozenset[bytes]) -> Iterator[pa.RecordBatch]:
    if held:
        langs = pa.concat_arrays([b.column(0) for b in held])
        texts = pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in held])
        yield from stripes_of(texts, langs, shards, frequent).batches()


def _cut(a: str, left: str, right: str) -> F.Column:
    """Score of a cut, floored; exact in decimals of 38 digits."""
    big = [F.col(c).cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * big[0] * big[0], big[1] * big[2])


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    found = written(counted(docs, least), "stripes")
    totals = found.filter("second IS NULL").groupBy("lang", "first").agg(F.sum("n").alias("f"))
    n = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    words = totals.filter(F.col("f") >= least)
    pairs = found.filter("second IS NOT NULL AND third IS NULL").drop("third")
    triples = found.filter("third IS NOT NULL").drop("longer")

    def named(df: DataFrame, count: str, **columns: str) -> DataFrame:
        return df.select(*[F.col(old).alias(f"_{new}") for new, old in columns.items()], F.col(count).alias(f"_{count}"))

    def counts(left: DataFrame, keys: list[str], right: DataFrame, count: str, columns: list[str], name: str, how: str = "inner") -> DataFrame:
        """The right side's count of a part of the phrase, as a column."""
        side = named(right, count, **{f"k{k}": c for k, c in enumerate(columns)})
        on = [f"_k{k}" for k in range(len(columns))]
        return keyed_join(left, side, keys, on, how).withColumnRenamed(f"_{count}", name).drop(*on)

    before = triples.groupBy("lang", "second", "third").agg(F.max("n").alias("most"))
    two = counts(pairs, ["lang", "first", "second"], before, "most", ["lang", "second", "third"], "left_longer", "left")
    widest = F.greatest(F.coalesce("left_longer", F.lit(0)), F.col("longer"))
    two = two.filter(100 * widest < SUBSUMED_PERCENT * F.col("n"))  # no extension often enough: zero
    two = counts(two, ["lang", "first"], words, "f", ["lang", "first"], "l")
    two = counts(two, ["lang", "second"], words, "f", ["lang", "first"], "r")
    two = two.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), F.col("n").alias("a"), "l", "r", _cut("n", "l", "r").alias("score"))

    three = counts(triples, ["lang", "first"], words, "f", ["lang", "first"], "l1")
    three = counts(three, ["lang", "second", "third"], pairs, "n", ["lang", "first", "second"], "r1")
    three = counts(three, ["lang", "first", "second"], pairs, "n", ["lang", "first", "second"], "l2")
    three = counts(three, ["lang", "third"], words, "f", ["lang", "first"], "r2")
    three = three.withColumns({"s1": _cut("n", "l1", "r1"), "s2": _cut("n", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), F.col("n").alias("a"),
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # Spark keeps the first rows of each language in every task before the exchange.
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
