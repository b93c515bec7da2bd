"""Whitening against exact sums and a library's eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.helpers import SF_DIR
from tidemart.llm import queries, whitening


def check(rows, vectors, components=8):
    """``vectors``: (id, entries) to fit, each id once."""
    ids = [i for i, _ in vectors]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in vectors]
    n, dim = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    found = {(r.vec_id, r.component): r for r in rows}
    count = min(components, dim)
    assert set(found) == {(i, c) for i in ids for c in range(1, count + 1)} and len(rows) == len(found)
    for i, row in zip(ids, x):
        exact = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        assert all(found[i, c].n == n and found[i, c].deviation == exact for c in range(1, count + 1))
    for c in range(count):
        ours = np.array([found[i, c + 1].whitened for i in ids])
        theirs = centred @ axes[:, c] / np.sqrt(values[c])
        sign = np.sign(ours @ theirs)
        assert np.allclose(ours, sign * theirs, atol=1e-7)
        explained = {found[i, c + 1].explained for i in ids}
        assert len(explained) == 1 and explained.pop() == pytest.approx(values[c] / np.trace(v), rel=1e-9)
    assert all(0 <= r.identity_error < 1e-9 for r in rows)


def table(spark, rows, extra=""):
    schema = "vec_id long, embedding array<float>" + (f", {extra} string" if extra else "")
    return spark.createDataFrame([(*r, "x") if extra else r for r in rows], schema)


def test_query(spark):
    rows = queries.op12_qdwh_whitening(spark, SF_DIR).collect()
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check(rows, [v for v in vectors if v[1] is not None and all(c is not None and math.isfinite(c) for c in v[1])])


def test_bad_vectors_are_dropped(spark):
    random = np.random.default_rng(2)
    good = [(k, [float(c) for c in random.normal(0, 1, 5)]) for k in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (104, []), (105, [1e12, 0.0, 0.0, 0.0, 0.0]), (106, [1.0, 2.0])]
    rows = whitening.whiten(table(spark, [*bad, *good], extra="whitened").repartition(3)).collect()
    check(rows, good)


def test_degenerate(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    one = whitening.whiten(table(spark, [(7, [0.5, 1.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, None), (2, 1, 0, None, 0.0, None)]
    line = whitening.whiten(table(spark, [(None, [float(k), 2.0 * k]) for k in range(5)] * 2)).collect()
    assert len(line) == 20 and {r.vec_id for r in line} == {None} and {r.n for r in line} == {10}
    assert all((r.whitened is None) == (r.component == 2) for r in line) and {r.identity_error < 1e-9 for r in line} == {True}


def test_large_counts_stay_exact():
    big = whitening.Moments(1 << 40, [3 << 40, 5 << 40], 1 << 30)
    centred, deviation = big.centred(np.array([[3, 5], [4, 5]], np.int64))
    assert centred.tolist() == [[0, 0], [1, 0]] and deviation == [0, None]
    assert whitening.Moments(1 << 20, [3 << 20], 9).centred(np.array([[5]]))[1] == [1 << 42]


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [1, 1, 1, 1], [0, 0, 0], [3, 3, 1, 1, 0], [1, 0, -1], [2], [1e8, 1, 1e-8, 0], list(0.5 ** np.arange(40.0)),
    [4.0, 4.0 * (1 + 1e-13), 1.0],
])
def test_divide_and_conquer(values):
    size = len(values)
    turn, _ = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))
    v = turn @ np.diag(values) @ turn.T
    v = (v + v.T) / 2
    scale = max(np.abs(values).max(), 1e-300)
    for wanted in (None, 2):
        found, axes = whitening.eigenpairs(v, wanted)
        top = np.sort(values)[::-1][:len(found)]
        assert len(found) >= min(size, wanted or size) and np.allclose(found, top, atol=1e-13 * size * scale)
        assert np.allclose(axes.T @ axes, np.eye(len(found)), atol=1e-13)
        assert np.abs(v @ axes - axes * found).max() <= 1e-13 * size * scale


def test_polar_factor_is_a_sign():
    random = np.random.default_rng(0)
    a = random.normal(size=(30, 30))
    a = a + a.T
    sign = whitening.polar_factor(a)
    values, axes = np.linalg.eigh(a)
    assert np.allclose(sign, axes @ np.diag(np.sign(values)) @ axes.T, atol=1e-12)
