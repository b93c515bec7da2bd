import re

import numpy as np
import pytest

from tests.llm.helpers import ODD_TEXTS, SF_DIR, documents, spaced_words
from tidemart.llm import quality as Q
from tidemart.llm import queries


def plain_counts(text):
    text = text or ""
    words, seen, dup = spaced_words(text), set(), 0
    for line in text.split("\n"):
        dup += bool(spaced_words(line)) and line in seen
        seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_query_counts_are_the_brute_force_ones(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r[c] for c in COUNTS) for r in queries.op1_line_field(spark, SF_DIR).collect()}
    assert found == {r.doc_id: plain_counts(r.text) for r in docs}


def test_verdict_follows_the_labels_of_other_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.fit(docs, labels.filter("doc_id % 2 = 0"))
    judged = Q.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed")
    rows = [(r.quality, r.kept) for r in judged.select("quality", "kept").collect()]
    good, bad = [k for q, k in rows if q == 1], [k for q, k in rows if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.25


def test_a_huge_labelled_text_leaves_the_others(spark, monkeypatch):
    """Longer than the bound on lines and first by hash or not: the field is still trained, in any order of rows."""
    monkeypatch.setattr(Q, "MAX_SAMPLE_LINES", 200)
    good, bad = "A plain sentence of some words stands here.\n" * 1 + "Another one follows it, longer than before.", "HOME | ABOUT\n## $$ >>\nCLICK!!! 1234"
    texts = [(k, good if k % 2 else bad) for k in range(1, 21)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(31)], "doc_id long, quality int, toxic int")
    plain = Q.fit(documents(spark, texts), labels)
    assert not np.array_equal(plain.weights, Q.all_content().weights)
    for huge in ([(0, "x\n" * 300)], [(k, "x\n" * 300) for k in range(21, 31)]):
        for docs in (huge + texts, texts[::-1] + huge):
            model = Q.fit(documents(spark, docs).coalesce(1), labels)
            assert np.array_equal(model.weights, plain.weights) and np.array_equal(model.moves, plain.moves)


def random_field(seed, n_lines):
    random = np.random.default_rng(seed)
    field = Q.Field(random.normal(size=3), random.normal(size=(2, 2)))
    return field, random.normal(size=(n_lines, 3)), random


def path_score(field, x, path):
    return field.scores(x)[np.arange(len(x)), path].sum() + sum(field.moves[a, b] for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_finds_the_best_path(seed):
    lengths = np.array([3, 1, 7, 5, 1])
    field, x, _ = random_field(seed, lengths.sum())
    state = field.decode(x, lengths)
    for first, n in zip(np.cumsum(lengths) - lengths, lengths):
        paths = [[k >> i & 1 for i in range(n)] for k in range(2**n)]
        best = max(paths, key=lambda p: path_score(field, x[first:first + n], p))
        assert state[first:first + n].tolist() == best


def test_gradient_is_that_of_the_likelihood():
    lengths = np.array([4, 1, 3])
    field, x, random = random_field(1, lengths.sum())
    y = random.integers(0, 2, lengths.sum())

    def likelihood(f):
        total = 0.0
        for first, n in zip(np.cumsum(lengths) - lengths, lengths):
            part = x[first:first + n]
            every = [path_score(f, part, [k >> i & 1 for i in range(n)]) for k in range(2**n)]
            total += path_score(f, part, y[first:first + n].tolist()) - np.logaddexp.reduce(every)
        return total / len(x)

    weights, moves = field.gradient(x, y, Q.Chains(lengths).steps())
    for k in range(3):
        step = np.eye(3)[k] * 1e-6
        assert weights[k] == pytest.approx((likelihood(Q.Field(field.weights + step, field.moves)) - likelihood(field)) / 1e-6, abs=1e-4)
    for a in range(2):
        for b in range(2):
            step = np.zeros((2, 2))
            step[a, b] = 1e-6
            assert moves[a, b] == pytest.approx((likelihood(Q.Field(field.weights, field.moves + step)) - likelihood(field)) / 1e-6, abs=1e-4)


def test_odd_rows(spark, rows):
    texts = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "one"), (None, "a b c d e f g h " * 2), (50, "one two\n\none two\n \n \n" * 6)]
    docs = documents(spark, texts, extra="kept")
    labels = spark.createDataFrame([(0, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    found = Q.quality(docs, labels)
    assert rows(found.select("doc_id", *COUNTS)) == sorted(((i, *plain_counts(t)) for i, t in texts), key=repr)
    assert found.filter("kept = base_failed").count() == 0  # without labels of both kinds the base rules decide
    kept = Q.kept(docs, labels)
    assert kept.columns == docs.columns and kept.count() == found.filter("kept").count()


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.quality(documents(spark, []), labels).count() == 0
