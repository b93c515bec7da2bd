import zlib

import numpy as np

from tests.llm.helpers import ODD_TEXTS, SF_DIR, documents
from tidemart.llm import queries
from tidemart.llm import toxicity as X


def test_query_columns_and_folds(spark):
    found = queries.op10_convolutional_toxicity(spark, SF_DIR).collect()
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    labelled = docs.join(labels.select("doc_id", "toxic"), "doc_id").select("doc_id", "text", "toxic")
    rows = X.score(labelled, X.fit(docs, labels)).filter("held_out").select("toxic", "predicted").collect()
    toxic = np.mean([r.predicted for r in rows if r.toxic == 1])
    clean = np.mean([r.predicted for r in rows if r.toxic == 0])
    assert toxic > 0.85 and clean < 0.05


def test_pooling_over_parts(monkeypatch):
    net = X.TextNet()
    ids = np.random.default_rng(0).integers(0, 1 << 47, 101) & 0x7FFF7FFF7FFF
    whole = net.pooled(ids)
    plain = np.zeros_like(whole).reshape(len(X.WIDTHS), X.FILTERS)
    x = np.concatenate([net.vectors(ids), np.zeros((2, X.SIZE))])
    for k, w in enumerate(X.WIDTHS):
        for t in range(len(ids)):
            z = sum(x[t + j] @ net.filters[k][j] for j in range(w)) + net.bias[k]
            plain[k] = np.maximum(plain[k], z)
    assert np.allclose(whole, plain.ravel(), atol=1e-5)
    monkeypatch.setattr(X, "PART", 10)
    assert np.allclose(net.pooled(ids), whole)


def test_odd_rows(spark):
    texts = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "one"), (None, "one")]
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, None), (None, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    found = X.toxicity(documents(spark, texts, extra="score"), labels).collect()
    assert len(found) == len(texts) and all(0 <= r.score < 0.5 and r.predicted == 0 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]


def test_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.toxicity(documents(spark, []), labels).count() == 0
