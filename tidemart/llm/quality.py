"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Every line of a text gets a few numbers (length, shares of symbols, capitals, digits,
and so on). A chain over the lines, with two states, is decoded by the Viterbi
algorithm; a document is kept if it passes the base rules and at least ``MIN_CONTENT``
of its words stand in content lines.

The field is trained here, on ``SAMPLE`` labelled documents at most (those with the least
hash of their id) with ``MAX_SAMPLE_LINES`` lines in all: tasks send the lines' numbers, not
the texts, to the driver. Documents are taken in the order of that hash; one that would pass
the bound is left out by itself, later ones still count. Lines of documents labelled good count as content, lines of bad ones and lines that repeat an earlier
line as boilerplate. Decoding and all counts cover every document and whole texts.

Defined cases: a null or wordless text has zero counts, fails the base rules and is not
kept; repeated documents each get their row; null labels are not used; without labels
of both kinds every line counts as content; an empty table gives no rows; columns named
as the added ones are replaced.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import append_columns, field, raw_texts

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
MIN_CONTENT = 0.5
SAMPLE, MAX_SAMPLE_LINES = 3000, 200_000
STEPS, RATE, PENALTY = 150, 0.15, 1e-5
FEATURES = ("bias", "words", "symbols", "capitals", "digits", "bangs", "ends", "word_length", "short", "repeats", "first", "bars", "echoes")


def _byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


_SPACE = _byte_set(b" \t\n\r\x0b\x0c")
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)], np.uint8)
_SYMBOL = _byte_set(b"#*$%&|<>")
_CAPITAL = _byte_set(bytes(range(65, 91)))
_BAR = _byte_set(b"|")
_DIGIT = _byte_set(b"0123456789")
_BANG = _byte_set(b"!?")
_END = _byte_set(b".!?")


class Lines:
    """Counts of the lines of a batch of texts, side by side in flat arrays."""

    def __init__(self, texts: list[bytes | None]):
        self.texts = [t or b"" for t in texts]
        self.buffer = b"\n".join(self.texts) + b"\n"
        a = np.frombuffer(self.buffer, np.uint8)
        ends = np.flatnonzero(a == 10)
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        self.per_doc = np.array([t.count(b"\n") + 1 for t in self.texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.per_doc)[:-1]])
        space = _SPACE[a]
        word_start = (1 - space) & np.concatenate([[1], space[:-1]]).astype(np.uint8)
        self.words = self._sum(word_start)
        self.word_chars = self._sum(_LEAD[a] & (1 - space))
        self.symbols = self._sum(_SYMBOL[a])
        self.capitals = self._sum(_CAPITAL[a])
        self.digits = self._sum(_DIGIT[a])
        self.bangs = self._sum(_BANG[a])
        self.ends = _END[a[np.maximum(ends - 1, 0)]] & (ends > self.starts)
        self.bars = self._sum(_BAR[a])
        self.repeats = self._repeated_lines()
        numbers: dict[bytes, int] = {}
        self.word_ids = np.fromiter(map(numbers.setdefault, self.buffer.split(), count()), np.int64, int(self.words.sum()))
        self.echoes = self._echoes()

    def _sum(self, mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, self.starts, dtype=np.int64)

    def _repeated_lines(self) -> np.ndarray:
        out = np.zeros(len(self.starts), bool)
        for first, n, text in zip(self.first.tolist(), self.per_doc.tolist(), self.texts, strict=True):
            if n > 1:
                seen: set[bytes] = set()
                for k, line in enumerate(text.split(b"\n")):
                    if line in seen:
                        out[first + k] = True
                    seen.add(line)
        return out & (self.words > 0)

    def _echoes(self) -> np.ndarray:
        """Words equal to the word before them in the line."""
        line = np.repeat(np.arange(len(self.words)), self.words)
        same = (self.word_ids[1:] == self.word_ids[:-1]) & (line[1:] == line[:-1])
        return np.bincount(line[1:][same], minlength=len(self.words))

    def by_doc(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first, dtype=np.int64)

    def repeat_words(self, size: int = REPEAT_WINDOW) -> np.ndarray:
        """Words in windows of ``size`` (a power of two) words that occur twice or more in the text."""
        n_words = self.by_doc(self.words)
        ids, total, width = self.word_ids, len(self.word_ids), 1
        while width < size and len(ids) > width:
            ids = pd.factorize(ids[:-width] * total + ids[width:])[0]  # equal windows of twice the width, equal ids
            width *= 2
        doc = np.repeat(np.arange(len(n_words)), n_words)
        covered = np.zeros(total + 1, np.int64)
        if total >= size:
            inside = np.flatnonzero(doc[size - 1:] == doc[:total - size + 1])
            again = inside[pd.Series(ids[inside] * len(n_words) + doc[inside]).duplicated(keep=False).to_numpy()]
            covered[again] += 1
            np.add.at(covered, again + size, -1)
        hit = np.cumsum(covered)[:-1] > 0
        return np.bincount(doc[hit], minlength=len(n_words))

    def features(self) -> np.ndarray:
        chars = np.maximum(self.word_chars, 1)
        words = np.maximum(self.words, 1)
        first = np.zeros(len(self.starts))
        first[self.first] = 1
        return np.column_stack([
            np.ones(len(chars)), np.log1p(self.words) / 4, self.symbols / words, self.capitals / chars, self.digits / chars,
            self.bangs / words, self.ends, self.word_chars / words / 10, self.words < 4, self.repeats, first,
            self.bars / words, self.echoes / words,
        ]).astype(np.float64)


class Chains:
    """Walks over many chains at once: step t visits the t-th line of every chain that has one."""

    def __init__(self, lengths: np.ndarray):
        self.first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.longest_first = lengths[self.order]

    def steps(self) -> list[np.ndarray]:
        n = int(self.longest_first[0]) if len(self.longest_first) else 0
        alive = np.searchsorted(-self.longest_first, -np.arange(n), side="left")
        return [self.first[self.order[:k]] + t for t, k in enumerate(alive)]


class Field:
    """Weights of a two-state linear chain: 0 is boilerplate, 1 is content."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.zeros(len(x)), x @ self.weights])

    def decode(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best state of every line (Viterbi)."""
        score, steps = self.scores(x), Chains(lengths).steps()
        back = np.zeros((len(x), 2), np.int8)
        best = score.copy()
        for t in range(1, len(steps)):
            here = steps[t]
            came = best[steps[t - 1][:len(here)]][:, :, None] + self.moves[None]
            back[here] = came.argmax(axis=1)
            best[here] += came.max(axis=1)
        state = best.argmax(axis=1).astype(np.int8)  # right for last lines, then overwritten backwards
        for t in range(len(steps) - 1, 0, -1):
            here = steps[t]
            state[steps[t - 1][:len(here)]] = back[here, state[here]]
        return state

    def gradient(self, x: np.ndarray, y: np.ndarray, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean log-likelihood, by forward and backward sums."""
        score = self.scores(x)
        ahead, after = score.copy(), np.zeros_like(score)
        for t in range(1, len(steps)):
            here = steps[t]
            ahead[here] += np.logaddexp.reduce(ahead[steps[t - 1][:len(here)]][:, :, None] + self.moves[None], axis=1)
        for t in range(len(steps) - 1, 0, -1):
            here = steps[t]
            after[steps[t - 1][:len(here)]] = np.logaddexp.reduce(
                self.moves[None] + (score[here] + after[here])[:, None, :], axis=2)
        total = np.logaddexp(*(ahead + after).T)
        share = np.exp(ahead[:, 1] + after[:, 1] - total)
        moves = np.zeros((2, 2))
        for t in range(1, len(steps)):
            here = steps[t]
            was = steps[t - 1][:len(here)]
            both = ahead[was][:, :, None] + self.moves[None] + (score[here] + after[here])[:, None, :]
            moves -= np.exp(both - total[here][:, None, None]).sum(axis=0)
            np.add.at(moves, (y[was], y[here]), 1)
        return (y - share) @ x / len(x), moves / len(x)


def train(x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> Field:
    """Fit by Adam on the penalised likelihood of the labels ``y`` of all lines."""
    field_, steps = Field(np.zeros(x.shape[1]), np.zeros((2, 2))), Chains(lengths).steps()
    params = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for k in range(1, STEPS + 1):
        g = np.concatenate([part.ravel() for part in field_.gradient(x, y, steps)]) - PENALTY * params
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params + RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        field_ = Field(params[:-4], params[-4:].reshape(2, 2))
    return field_


def all_content() -> Field:
    """The field that calls every line content."""
    return Field(np.eye(1, len(FEATURES))[0], np.zeros((2, 2)))


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """Train on the lines of a bounded sample of labelled documents."""
    good = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("__label"))
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = chosen.collect()
    if len({r["__label"] for r in rows}) < 2:
        return all_content()
    spark = docs.sparkSession
    named = spark.createDataFrame([(r["doc_id"], r["__label"]) for r in rows], "doc_id long, __label int")
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(named), "doc_id")

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        lines = Lines(raw_texts(batch))
        x, n = lines.features(), lines.per_doc
        parts = np.split(np.concatenate([x, lines.repeats[:, None]], axis=1).astype("<f4"), np.cumsum(n)[:-1])
        return [pa.array([p.tobytes() for p in parts], pa.binary())]

    key = F.xxhash64("text").alias("__text")
    n_lines = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^\n]", "")) + 1
    sizes = sample.select("doc_id", key, n_lines.alias("n")).groupBy("doc_id", "__text", "n").agg(F.count("*").alias("copies"))
    ordered = sizes.orderBy(F.xxhash64("doc_id"), "doc_id", "__text").limit(2 * SAMPLE).collect()
    places: dict[tuple[int, int], int] = {}
    total = 0
    for row in ordered:
        if total + row["n"] * row["copies"] > MAX_SAMPLE_LINES:
            continue
        total += row["n"] * row["copies"]
        places[row["doc_id"], row["__text"]] = len(places)
    if not places:
        return all_content()
    taken = spark.createDataFrame([(*k, at) for k, at in places.items()], "doc_id long, __text long, __at long")
    fetched = sample.withColumn("__text", key).join(F.broadcast(taken), ["doc_id", "__text"])
    found = append_columns(fetched, [field("__lines", T.BinaryType())], lambda: compute)
    xs, ys, ns = [], [], []
    for row in sorted(found.select("__at", "__label", "__lines").collect(), key=lambda r: r["__at"]):
        x = np.frombuffer(row["__lines"], "<f4").reshape(-1, len(FEATURES) + 1).astype(np.float64)
        xs.append(x[:, :-1])
        ys.append(np.where(x[:, -1] > 0, 0, row["__label"]))
        ns.append(len(x))
    if len({label for y in ys for label in y.tolist()}) < 2:
        return all_content()
    return train(np.concatenate(xs), np.concatenate(ys).astype(np.int64), np.array(ns))


def score(docs: DataFrame, model: Field, text_col: str = "text") -> DataFrame:
    """Add the base counts, ``base_failed``, ``content_share`` and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [field(n, T.LongType()) for n in counts] + [
        field("base_failed", T.BooleanType()), field("content_share", T.DoubleType()), field("kept", T.BooleanType())]

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        lines = Lines(raw_texts(batch, text_col))
        words, repeat = lines.by_doc(lines.words), lines.repeat_words()
        failed = (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)
        state = shared.value.decode(lines.features(), lines.per_doc)
        share = lines.by_doc(lines.words * state) / np.maximum(words, 1)
        numbers = [words, lines.by_doc(lines.word_chars), lines.by_doc(lines.symbols), lines.by_doc(lines.repeats), repeat]
        return [
            *[pa.array(n.astype(np.int64)) for n in numbers],
            pa.array(failed), pa.array(share), pa.array(~failed & (share >= MIN_CONTENT)),
        ]

    return append_columns(docs, fields, lambda: _unless_empty(compute, fields))


def _unless_empty(compute, fields):
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if not batch.num_rows:
            kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
            return [pa.array([], kinds[f.dataType.simpleString()]) for f in fields]
        return compute(batch)

    return run


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with counts, the content share and the verdict of a field fitted to the labels."""
    return score(docs, fit(docs, labels))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents worth keeping, with the columns of the input."""
    plain = docs.select(*[F.col(c).alias(f"__in_{i}") for i, c in enumerate(docs.columns)], F.col("text").alias("text"))
    judged = score(plain, fit(docs, labels)).filter("kept")
    return judged.select(*[F.col(f"__in_{i}").alias(c) for i, c in enumerate(docs.columns)])
