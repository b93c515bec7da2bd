import math
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import ODD_TEXTS, SF_DIR, documents, spaced_words
from tidemart.llm import backoff, queries


def plain_scores(texts, order):
    split = [spaced_words(t) for t in texts]

    def grams(words):
        return Counter(tuple(words[i:i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1))

    own = [grams(w) for w in split]
    every, n = sum(own, Counter()), sum(map(len, split))
    for words, mine in zip(split, own, strict=True):
        rest, total, backed = max(n - len(words), 1), 0.0, 0

        def score(gram):
            others = every[gram] - mine[gram]
            if len(gram) == 1:
                return (others or backoff.UNSEEN) / rest, others > 0, 1
            if others > 0:
                return others / (every[gram[:-1]] - mine[gram[:-1]]), True, len(gram)
            lower = score(gram[1:])
            return backoff.ALPHA * lower[0], lower[1], lower[2]

        for i in range(len(words)):
            longest = tuple(words[max(0, i - order + 1):i + 1])
            value, _, used = score(longest)
            total += math.log10(value)
            backed += used < len(longest)
        yield len(words), total, backed


def same(found, expected):
    assert len(found) == len(expected)
    for f, e in zip(found, expected, strict=True):
        assert (f[0], f[1], f[3]) == (e[0], e[1], e[3])
        assert f[2] == pytest.approx(e[2], rel=1e-9, abs=1e-9)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))


def columns(df):
    return in_order([(r.doc_id, r.n_words, r.log10_score, r.n_backoff) for r in df.collect()])


def test_query_is_the_brute_force_result(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    plain = plain_scores([r.text for r in docs], backoff.ORDER)
    same(columns(queries.op9_stupid_backoff(spark, SF_DIR)), in_order([(r.doc_id, *p) for r, p in zip(docs, plain, strict=True)]))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_odd_rows(spark, order):
    texts = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "one"), (None, "one two three four"), (7, "two three four five")]
    found = columns(backoff.scores(documents(spark, texts, extra="n_words"), order))
    plain = plain_scores([t for _, t in texts], order)
    same(found, in_order([(i, *p) for (i, _), p in zip(texts, plain, strict=True)]))


def test_joined_word_pairs_score_below_fluent_text(spark):
    texts = [(0, "a b c")] * 4 + [(1, "d b e")] * 4 + [(2, "a b e")]
    found = {r.doc_id: r.log10_score for r in backoff.scores(documents(spark, texts)).collect()}
    assert found[2] < found[0] - 0.5 and found[2] < found[1] - 0.5


def test_empty_table(spark):
    assert backoff.scores(documents(spark, [])).count() == 0


def test_packed_keys_are_near_their_entropy():
    """Of 64 bits, n sorted even keys need about 64 - log2(n) + 1.45 each; counts of one next to nothing."""
    random = np.random.default_rng(1)
    for n in (1, 2, 300, 20_000):
        keys = np.unique(random.integers(0, 1 << 64, n, dtype=np.uint64))
        assert np.array_equal(backoff._unpacked(backoff._packed(keys)), keys)
        counts = np.where(np.arange(n) % 7, 2, random.integers(0, 1 << 40, n))
        assert np.array_equal(backoff._values(backoff._planes(counts)), counts)
    entropy = (64 - np.log2(n) + 1.45) / 8 * n
    assert len(backoff._packed(keys)) < 1.02 * entropy + 100
    assert len(backoff._planes(np.full(n, 2))) < 100


def test_texts_travel_compressed(spark):
    """A chunk's rows are one block, much smaller than its texts."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    blocks = backoff._blocks(backoff._chunked(docs)).collect()
    size = sum(len(r.text.encode()) for r in docs.select("text").collect() if r.text)
    assert len({r.chunk for r in blocks}) == len(blocks)
    assert sum(len(r.block) for r in blocks) < 0.6 * size
