"""Best-two-fit packing against a piece-by-piece version and the library's ids."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, SF_DIR, documents
from tidemart.llm import best_fit, queries, tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def plain_bins(lengths, window):
    """The rule, one piece after another."""
    left, bins = sorted(lengths), []
    while left:
        bin_ = []
        while fitting := [n for n in left if n <= window - sum(bin_)]:
            bin_.append(fitting[-1])
            left.remove(fitting[-1])
        while sum(bin_) < window and len(bin_) > 1:
            room = window - sum(bin_) + bin_[-1]
            pairs = [(left[i] + left[j], left[j], left[i]) for j in range(len(left)) for i in range(j) if left[i] + left[j] <= room]
            if not pairs or max(pairs)[0] <= bin_[-1]:
                break
            _, a, b = max(pairs)
            out = bin_.pop()
            left.remove(a)
            left.remove(b)
            left = sorted([*left, out])
            bin_ = sorted([*bin_, a, b], reverse=True)
        bins.append(tuple(bin_))
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(40, 60))
def test_plan_is_the_rule(lengths, window):
    patterns = best_fit.plan(Counter(lengths), window)
    assert [p.lengths for p in patterns for _ in range(p.bins)] == plain_bins(lengths, window)


def test_a_pair_replaces_the_smallest():
    assert [p.lengths for p in best_fit.plan(Counter([6, 3, 2, 2]), 10)] == [(6, 2, 2), (3,)]


def test_plan_grows_with_lengths_not_with_documents():
    lengths = np.bincount(np.clip(np.random.default_rng(3).lognormal(4, 1, 5000).astype(int), 1, 512))
    few, many = (best_fit.plan({n: int(c) * k for n, c in enumerate(lengths)}, 512) for k in (1, 10_000))
    assert len(many) < 3 * 512 and sum(p.bins for p in many) <= 10_000 * sum(p.bins for p in few)
    total = sum(n * int(c) for n, c in enumerate(lengths)) * 10_000
    assert sum(p.bins for p in many) <= 1.001 * -(-total // 512)


def holds(rows, texts, library, window, end_id):
    """Every id in exactly one piece, cut only beyond a window; sequences gapless and not too long."""
    expected = Counter()
    for doc, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        for number, at in enumerate(range(0, len(ids), window)):
            expected[(doc, number, at, len(ids[at:at + window]), np.array(ids[at:at + window], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows) == expected
    sequences = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert sequences.setdefault(r.sequence_id, 0) == r.offset
        sequences[r.sequence_id] += r.length
    assert max(sequences.values(), default=0) <= window
    return sequences


@pytest.mark.parametrize("window", [7, 512])
def test_odd_rows(spark, library, window):
    texts = [*enumerate(ODD_TEXTS), (3, "one"), (None, "no id"), (40, "word " * 3000), (40, "word " * 3000)]
    docs = documents(spark, texts, extra="sequence_id").repartition(3)
    packed = best_fit.pack(docs, window=window, end_id=1)
    rows = packed.collect()
    sequences = holds(rows, texts, library, window, 1)
    assert sorted(sequences.values()) == sorted(map(sum, plain_bins([r.length for r in rows], window)))
    whole = {r.sequence_id: r for r in best_fit.sequences(packed).collect()}
    assert {k: len(r.ids) // 4 for k, r in whole.items()} == sequences
    for r in rows:
        assert bytes(whole[r.sequence_id].ids)[4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_query(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = queries.op11_best_two_fit(spark, SF_DIR).collect()
    ids = {doc: [*library.encode(text or "", add_special_tokens=False).ids, 1] for doc, text in docs}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
    bins = len({r.sequence_id for r in rows})
    assert bins == len(plain_bins([r.length for r in rows], best_fit.WINDOW)) and bins - sum(r.length for r in rows) / 4096 < 1.5


def test_empty_table(spark):
    assert best_fit.pack(documents(spark, [])).collect() == []
