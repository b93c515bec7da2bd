"""Collocations against counting phrase by phrase."""

import re
from collections import Counter, defaultdict

import pytest

from tests.compare import connect, difference
from tests.llm.helpers import ODD_TEXTS, SF_DIR, lower_ascii
from tidemart.llm import collocations, queries, sql


def plain(rows, least=10, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for at in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[at:at + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            inside = [b for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * b >= 50 * a for b in inside):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def ours(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def docs(spark, rows):
    schema = "doc_id long, lang string, text string, rank string, phrase string, first string"
    return spark.createDataFrame([(k, *r, "x", "y", "z") for k, r in enumerate(rows)], schema)


ROWS = [
    *[(None, t) for t in ODD_TEXTS], ("und", "one two three"), ("en", "New York City. new york,NEW York\tCity" * 3),
    ("en", "a a a a b\nb a\r\na;a"), ("de", "Ärger Über ärger über ärger"), ("", "x y x y"), ("en", None), ("en", " . , "),
    ("en", "the cat " * 4000), ("en", "the dog " * 50), ("fr", "a\x00b c\x1cd " * 3), ("fr", "  lead a\x00b"),
]


@pytest.mark.parametrize("flush, entries, part", [(1 << 30, 1 << 30, 1 << 30), (1, 10, 2000)])
def test_odd_rows(spark, monkeypatch, flush, entries, part):
    """Whole, and with a stripe per batch, merges at every step and many partitions."""
    monkeypatch.setattr(collocations, "FLUSH_BYTES", flush)
    monkeypatch.setattr(collocations, "MERGE_ENTRIES", entries)
    monkeypatch.setattr(collocations, "BATCH_STRIPES", 3)
    monkeypatch.setattr(collocations.counted, "__defaults__", (10, part))
    frame = docs(spark, ROWS * 3).repartition(4)
    assert ours(collocations.collocations(frame)) == plain(ROWS * 3)
    assert ours(collocations.collocations(frame, least=2, top=4)) == plain(ROWS * 3, 2, 4)


def test_query_and_sql(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()]
    found = queries.op13_stripe_collocations(spark, SF_DIR)
    assert ours(found) == plain(rows)
    assert difference(found, connect(SF_DIR), sql.phrases()) is None


def test_scores_beyond_64_bits(spark):
    values = [(3_000_000_000_001, 3_000_000_000_007, 4_000_000_000_000), (10, 10, 10)]
    frame = spark.createDataFrame(values, "a long, l long, r long").select("a", "l", "r", collocations._cut("a", "l", "r").alias("s"))
    assert [r.s for r in frame.collect()] == [10**6 * a * a // (l * r) for a, l, r in values]


def test_empty_table(spark):
    assert collocations.collocations(docs(spark, ROWS).limit(0)).collect() == []
    assert collocations.collocations(docs(spark, [(None, None), ("en", "")])).collect() == []
