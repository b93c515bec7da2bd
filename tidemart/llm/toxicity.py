"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word has three hash numbers, two of the whole word and one of its beginning, each with an
embedding; their sum goes through filters of several widths, each filter's greatest value over the whole text (max pooling) into a
logistic unit. A threshold is calibrated for each language, told by the letters of the
text itself, and subtracted, so that 0.5 is the calibrated border everywhere.

Training takes at most ``PER_CLASS`` labelled documents of each class (least hash of the
id) whose fold is not held out, and of those ``MAX_WORDS`` words in all, whole texts only; tasks send
hash numbers, not texts, to the driver. A fifth of them calibrates. Scoring covers every document and whole texts.

Defined cases: a null or wordless text scores like a text without any signal; null labels are not
used, a document labelled twice counts as toxic if one label says so; without labels of
both classes every score is below 0.5; a null id is not held out; repeated documents each
get their row; an empty table gives no rows; columns named as the added ones are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import append_columns, field, raw_texts
from tidemart.llm.decontaminate import words_of

BUCKETS, SIZE = 1 << 15, 16
#: Bytes of a word's beginning.
BEGINNING = 6
WIDTHS, FILTERS = (1, 2, 3), 8
PER_CLASS, MAX_WORDS = 2500, 4_000_000
EPOCHS, BATCH, RATE = 8, 32, 0.15
WORD_DROP, PENALTY = 0.2, 1e-4
FOLDS = 5
#: Words convolved at a time; a longer text is cut into overlapping parts, of which pooling takes the greatest.
PART = 100_000
#: Where the hash numbers stand in a word's integer.
FIELDS = (32, 16, 0)
_KEPT_WORDS = 300_000
#: Letters that tell a language, and what a text without any of them is taken for.
LETTERS = {"fr": "éèêçàù", "de": "äöüß", "es": "ñíó"}
OTHER = "en"
LANGUAGES = (*LETTERS, OTHER)


class WordHashes(dict):
    """The bucket numbers of a word in one integer, remembered for the words of a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _KEPT_WORDS:
            self.clear()
        low, high = zlib.crc32(word), zlib.crc32(word, 0x5BD1E995)
        begun = zlib.crc32(word[:BEGINNING], 0x2545F491)
        number = self[word] = (low % BUCKETS) << 32 | (high % BUCKETS) << 16 | begun % BUCKETS
        return number


def hashed(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(hashes.__getitem__, words), np.int64, len(words))


def language(text: bytes | None) -> int:
    """Number of the language whose letters occur most; ties go to the first."""
    if not text or text.isascii():
        return len(LETTERS)
    counts = [sum(text.count(c.encode()) for c in letters) for letters in LETTERS.values()]
    return int(np.argmax(counts)) if max(counts) else len(LETTERS)


class TextNet:
    """Embeddings, filters and the logistic unit."""

    def __init__(self, seed: int = 7):
        random = np.random.default_rng(seed)
        self.embedding = random.normal(0, 0.2, (len(FIELDS), BUCKETS, SIZE)).astype(np.float32)
        self.filters = [random.normal(0, 0.3 / np.sqrt(w), (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = random.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.base = np.float32(-1.0)
        self.threshold = np.zeros(len(LANGUAGES))

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return sum(self.embedding[k, ids >> shift & 0xFFFF] for k, shift in enumerate(FIELDS))

    def responses(self, x: np.ndarray, n: int, width: int) -> np.ndarray:
        """Filter outputs at the first n places of padded vectors."""
        w = WIDTHS[width]
        z = x[:n] @ self.filters[width][0]
        for k in range(1, w):
            z += x[k:n + k] @ self.filters[width][k]
        return np.maximum(z + self.bias[width], 0)

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        """Greatest output of every filter over a text."""
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        pad = np.zeros((max(WIDTHS) - 1, SIZE), np.float32)
        for at in range(0, len(ids), PART):
            part = ids[at:at + PART + len(pad)]
            n = min(PART, len(ids) - at)
            x = np.concatenate([self.vectors(part), pad])
            here = np.concatenate([self.responses(x, n, k).max(axis=0) for k in range(len(WIDTHS))])
            best = np.maximum(best, here)
        return best

    def logit(self, ids: np.ndarray) -> float:
        return float(self.pooled(ids) @ self.out + self.base)

    def score(self, ids: np.ndarray, spoken: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(ids) - self.threshold[spoken], -30, 30))))


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> TextNet:
    """Adagrad on the weighted logistic loss; only the words under a filter's maximum get a gradient."""
    net, random = TextNet(seed), np.random.default_rng(seed)
    sums = [np.full_like(a, 1e-6) for a in (net.embedding, *net.filters, net.bias, net.out)]
    base_sum = 1e-6
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    pad = np.zeros((max(WIDTHS) - 1, SIZE), np.float32)
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            g_filters = [np.zeros_like(f) for f in net.filters]
            g_bias, g_out, g_base = np.zeros_like(net.bias), np.zeros_like(net.out), 0.0
            rows, grads = [], []
            for d in order[at:at + BATCH]:
                ids = texts[d][random.random(len(texts[d])) >= WORD_DROP]
                if not len(ids):
                    continue
                x, n = np.concatenate([net.vectors(ids), pad]), len(ids)
                outputs = [net.responses(x, n, k) for k in range(len(WIDTHS))]
                peaks = [z.argmax(axis=0) for z in outputs]
                pool = np.concatenate([z[p, np.arange(FILTERS)] for z, p in zip(outputs, peaks, strict=True)])
                p = 1 / (1 + np.exp(-np.clip(pool @ net.out + net.base, -30, 30)))
                error = np.float32((p - labels[d]) * weight[d] / BATCH)
                g_out += error * pool
                g_base += error
                back = (error * net.out * (pool > 0)).reshape(len(WIDTHS), FILTERS)
                g_bias += back
                for k, w in enumerate(WIDTHS):
                    for j in range(w):
                        place = peaks[k] + j
                        g_filters[k][j] += (x[place] * back[k][:, None]).T
                        real = place < n
                        rows.append(ids[place[real]])
                        grads.append((net.filters[k][j] * back[k]).T[real])
            pairs = [*zip(net.filters, g_filters, sums[1:-2], strict=True), (net.bias, g_bias, sums[-2]), (net.out, g_out, sums[-1])]
            for value, g, total in pairs:
                g = g + PENALTY * value
                total += g * g
                value -= RATE * g / np.sqrt(total)
            base_sum += g_base**2
            net.base -= np.float32(RATE * g_base / np.sqrt(base_sum))
            if rows:
                ids, g = np.concatenate(rows), np.concatenate(grads)
                for k, shift in enumerate(FIELDS):
                    some, inverse = np.unique(ids >> shift & 0xFFFF, return_inverse=True)
                    total = np.zeros((len(some), SIZE), np.float32)
                    np.add.at(total, inverse, g)
                    sums[0][k, some] += total * total
                    net.embedding[k, some] -= RATE * total / np.sqrt(sums[0][k, some])
    return net


def calibrate(net: TextNet, texts: list[np.ndarray], labels: np.ndarray, spoken: np.ndarray, least: int = 20) -> None:
    """Per language the logit that parts the classes best; with fewer than ``least`` of a class, the common one."""
    logits = np.array([net.logit(t) for t in texts])

    def border(mine: np.ndarray) -> float:
        values, y = logits[mine], labels[mine]
        order = np.argsort(values, kind="stable")
        values, y = values[order], y[order]
        # Right answers if all from place k on are called toxic, both classes weighing alike.
        right = np.concatenate([[0], np.cumsum(y == 0)]) / max((y == 0).sum(), 1)
        right = right + (y == 1).sum() / max((y == 1).sum(), 1) - np.concatenate([[0], np.cumsum(y == 1)]) / max((y == 1).sum(), 1)
        best = np.flatnonzero(right >= right.max() - 1e-12)
        k = int(best[len(best) // 2])
        low = values[k - 1] if k else values[0] - 1
        high = values[k] if k < len(values) else values[-1] + 1
        return float((low + high) / 2)

    common = border(np.ones(len(labels), bool))
    for number in range(len(LANGUAGES)):
        mine = spoken == number
        enough = min((labels[mine] == 0).sum(), (labels[mine] == 1).sum()) >= least
        net.threshold[number] = border(mine) if enough else common


def fold(doc_id: str | Column) -> Column:
    """Remainder of the id's CRC-32, as text, that deals documents to folds; a null id is in none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS, F.lit(-1))


def no_signal() -> TextNet:
    """The classifier that takes every text for clean."""
    net = TextNet()
    net.out[:] = 0
    return net


def fit(docs: DataFrame, labels: DataFrame) -> TextNet:
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(fold("doc_id") != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("__label"))
    rows = [
        row for label in (0, 1)
        for row in known.filter(F.col("__label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS).collect()
    ]
    if len({r["__label"] for r in rows}) < 2:
        return no_signal()
    named = docs.sparkSession.createDataFrame([(r["doc_id"], r["__label"]) for r in rows], "doc_id long, __label int")
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(named), "doc_id")

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        hashes, texts = WordHashes(), raw_texts(batch)
        ids = [hashed(t, hashes).astype("<i8").tobytes() for t in texts]
        return [pa.array(ids, pa.binary()), pa.array([language(t) for t in texts], pa.int32())]

    found = append_columns(sample, [field("__ids", T.BinaryType()), field("__spoken", T.IntegerType())], lambda: compute)
    texts, ys, spoken, total = [], [], [], 0
    for row in found.select("__label", "__ids", "__spoken").limit(4 * PER_CLASS).toLocalIterator():
        ids = np.frombuffer(row["__ids"], "<i8").astype(np.int64)
        if total + len(ids) > MAX_WORDS:
            continue
        total += len(ids)
        texts.append(ids)
        ys.append(row["__label"])
        spoken.append(row["__spoken"])
    if len(set(ys)) < 2:
        return no_signal()
    y, spoken = np.array(ys), np.array(spoken)
    order = np.random.default_rng(3).permutation(len(texts))
    held, used = order[:len(order) // 5], order[len(order) // 5:]
    if len(set(y[held].tolist())) < 2 or len(set(y[used].tolist())) < 2:
        held = used = order
    net = train([texts[k] for k in used], y[used])
    calibrate(net, [texts[k] for k in held], y[held], spoken[held])
    return net


def score(docs: DataFrame, net: TextNet, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Add held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def start():
        hashes = WordHashes()

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            model = shared.value
            values = [model.score(hashed(t, hashes), language(t)) for t in raw_texts(batch, text_col)]
            return [pa.array(values, pa.float64())]

        return compute

    scored = append_columns(docs.drop("held_out", "predicted"), [field("score", T.DoubleType())], start)
    return scored.withColumns({
        "held_out": fold(id_col) == 0, "predicted": (F.col("score") >= 0.5).cast("int"),
    })


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
