"""Operators on token ids: packing, files and counts, against the library itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import ODD_TEXTS, SF_DIR, documents
from tidemart.llm import packing, queries, simple8b, tokens, transducer

TEXTS = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [
    (3, "one"), (None, "no id"), (40, "naïve l'été d'où. 'twas they'll 'Rx ''ve" * 50), (41, "ab" * 9000 + " é"), (42, "x.y, z... <|ENDOFTEXT|> a<|startoftext|>b"),
    (43, "İΣ ẞ ﬁ Å Ω ªº ٠² 　  x​"), (44, "word " * 20000),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_is_the_library(library):
    encode, texts = tokens.Encoder(tokens.vocabulary_path()), [t for _, t in TEXTS]
    plain = [ids_of(library, t) for t in texts]
    for skipped in (0, 1):  # the second time from the table of known words
        coded = encode.encode(pa.array(texts).slice(skipped))
        assert [c.tolist() for c in coded] == plain[skipped:]
    assert encode.encode(pa.array([], pa.string())) == []


def pieces_hold(rows, texts, library, window):
    """Every id in exactly one piece, sequences gapless and not too long."""
    expected = {}
    for doc, text in texts:
        expected.setdefault(doc, []).append([*ids_of(library, text), 2])
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(expected)
    for doc, pieces in by_doc.items():
        if len(expected[doc]) == 1:
            at, ids = 0, expected[doc][0]
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
                assert r.ids_crc32 == crc(ids[at:at + r.length])
                at += r.length
            assert at == len(ids)
        else:
            assert sum(r.length for r in pieces) == sum(map(len, expected[doc]))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by_sequence


def test_packing_query(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    sequences = pieces_hold(queries.op4_retrieval_packing(spark, SF_DIR).collect(), docs, library, packing.WINDOW)
    total = sum(r.length for s in sequences.values() for r in s)
    assert len(sequences) == -(-total // packing.WINDOW)


@pytest.mark.parametrize("shard_tokens", [1 << 20, 3000])
def test_packing_odd_rows(spark, library, shard_tokens):
    docs = documents(spark, TEXTS, extra="start")
    pieces_hold(packing.pack(docs, window=512, shard_tokens=shard_tokens).collect(), TEXTS, library, 512)


def test_index_scores_are_bm25():
    random = np.random.default_rng(0)
    texts = [random.integers(0, 30, n) for n in (5, 40, 1, 17, 90)]
    idf, lengths, mean = np.maximum(random.normal(1, 1, 30), 0), np.array([9, 40, 1, 20, 95]), 33.0
    index = packing.InvertedIndex(texts, lengths, idf, mean)
    for query in [*texts, np.array([29, 29, 3])]:
        plain = []
        for text, length in zip(texts, lengths):
            norm = packing.K1 * (1 - packing.B + packing.B * length / mean)
            tf = {t: int((text == t).sum()) for t in set(query.tolist())}
            plain.append(sum(idf[t] * n * (packing.K1 + 1) / (n + norm) for t, n in tf.items() if n))
        assert np.allclose(index.scores(query), plain)


def test_neighbours_share_a_window():
    """Two topics in alternation: a seed takes its own topic's texts first."""
    texts = [np.arange(50) + 100 * (k % 2) for k in range(8)]
    idf = np.ones(200)
    index = packing.InvertedIndex(texts, np.full(8, 50), idf, 50.0)
    windows = list(packing.fill(texts, index, 200))
    assert [{d % 2 for d, _, _ in w} for w in windows] == [{0}, {1}]


def test_offers_are_brute_force_bm25_over_all_shards(spark):
    """The best of all shards, whatever their number, are those of one index over everything: recall 1."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = tokens.vocabulary_path()
    size = tokens.encoder(path).size
    ids = packing.written(packing.encoded(docs, path), "token-ids")
    counts, n_docs, n_tokens = packing.frequencies(ids, size)
    idf, mean = np.maximum(np.log((n_docs - counts + 0.5) / (counts + 0.5)), 0), n_tokens / n_docs
    shards = packing.dealt(ids, 7, size, packing.WINDOW).cache()
    parts = [packing.Shard(r.asDict(), "<u2") for r in shards.collect()]
    assert len(parts) == 7
    keys = np.concatenate([(p.number << 32) + np.arange(len(p.texts)) for p in parts])
    texts = [t for p in parts for t in p.texts]
    left = {p.number: np.arange(len(p.texts)) % 3 > 0 for p in parts}
    free = np.concatenate([left[p.number] for p in parts])
    whole = packing.InvertedIndex(texts, np.concatenate([p.doc_tokens for p in parts]), idf, mean)
    queries_ = [np.unique(t) for t in texts[::5]]
    found = packing.offers(shards, queries_, left, idf, mean, "<u2", 1 << 17)
    assert [q for q, _, _ in found] == list(range(len(queries_)))
    hit = total = 0
    for query, (_, key, score) in zip(queries_, found):
        every = whole.scores(query)[free]
        best = np.lexsort((keys[free], -every))[:10]
        assert np.allclose(score[:10], every[best])
        hit, total = hit + len(set(keys[free][best].tolist()) & set(key.tolist())), total + len(best)
    assert hit / total > 0.999


def test_chains_reach_every_shard(spark):
    """Four topics dealt over several shards: windows hold one topic each."""
    words = [[f"{chr(97 + k)}{chr(97 + a)}{chr(97 + b)}x" for a in range(8) for b in range(8)] for k in range(4)]
    random = np.random.default_rng(5)
    texts = [(i, " ".join(random.choice(words[i % 4], 60))) for i in range(400)]
    rows = packing.pack(documents(spark, texts), window=1024, shard_tokens=8000).collect()
    total = sum(r.length for r in rows)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.doc_id % 4, r.length))
    assert len(windows) == -(-total // 1024) and total // 8000 >= 4
    most = sum(max(sum(n for t, n in pieces if t == k) for k in range(4)) for pieces in windows.values())
    assert most / total > 0.8


@pytest.mark.parametrize("every", [2, 50, 1000])
def test_packing_odd_rows_by_queries(spark, library, monkeypatch, every):
    """No query, or several jobs of queries, or tokens beside the dense ones: every id stands in one place."""
    monkeypatch.setattr(packing, "QUERIES", 4)
    monkeypatch.setattr(packing, "DENSE", 20)
    docs = documents(spark, TEXTS if every < 1000 else [t for t in TEXTS if t[0]], extra="start")
    texts = TEXTS if every < 1000 else [t for t in TEXTS if t[0]]
    rows = packing.pack(docs, window=512, shard_tokens=3000, every=every).collect()
    sequences = pieces_hold(rows, texts, library, 512)
    assert len(sequences) == -(-sum(r.length for r in rows) // 512)


def test_queries_are_offered_the_best_of_all_shards(spark, monkeypatch):
    """Held against brute force: what queries are offered, who gets a rest that several are offered, and where the others go."""
    monkeypatch.setattr(packing, "DENSE", 300)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    path = tokens.vocabulary_path()
    size, window, reach = tokens.encoder(path).size, packing.WINDOW, 8000
    shards = packing.written(packing.shards_in_place(docs, path, window, 20_000), "shards")
    parts = list(packing._inflated((pa.RecordBatch.from_pylist([r.asDict()]) for r in shards.collect()), "<u2"))
    assert len(parts) > 6
    counts, n_docs, n_tokens = packing.frequencies(
        shards, size, lambda batch: (t for p in packing._inflated([batch], "<u2") for t in p.texts))
    idf, mean = np.maximum(np.log((n_docs - counts + 0.5) / (counts + 0.5)), 0), n_tokens / n_docs
    rests = {(p.number << 32) + k: (t, int(p.length[k]), p.doc_id[k]) for p in parts for k, t in enumerate(p.texts) if p.length[k]}
    key, length = np.array(list(rests)), np.array([n for _, n, _ in rests.values()])
    asking = np.sort([k for k, (_, _, d) in rests.items() if d % 10 == 0])
    texts = [np.unique(rests[k][0]) for k in asking.tolist()]
    whole = packing.InvertedIndex([t for t, _, _ in rests.values()], np.array([len(t) for t, _, _ in rests.values()]), idf, mean)
    scores = np.array([np.where(key == q, np.inf, whole.scores(t)) for q, t in zip(asking, texts)])
    offers = packing.asked(shards, asking, texts, idf, mean, "<u2", reach).cache()
    found: dict[int, set] = {}
    for r in offers.filter("offered").collect():
        found.setdefault(r.query, set()).add(r.key)
    hit = total = 0
    best: dict[int, tuple] = {}
    for q, score in zip(asking.tolist(), scores):
        order = np.lexsort((key, -score))
        order = order[:np.searchsorted(np.cumsum(length[order]), reach) + 1]
        hit, total = hit + len(set(key[order].tolist()) & found[q]), total + len(order)
        for k in order.tolist():
            best[int(key[k])] = max(best.get(int(key[k]), (-1, 0)), (score[k], -q))
    assert hit / total > 0.999
    rows = packing.chosen(offers, reach).collect()
    assert sorted(r.key for r in rows) == sorted(rests)
    place = {int(k): at for at, k in enumerate(key)}
    right = sum(r.query == -best[r.key][1] if r.key in best else np.isclose(
        scores[:, place[r.key]].max(), scores[np.searchsorted(asking, r.query), place[r.key]], rtol=1e-4) for r in rows)
    assert right / len(rows) > 0.99 and 0 < len(best) < len(rests)


def test_product_leaves_out_tokens_that_few_queries_hold():
    """The cost of the matrix product follows the queries' tokens, and the scores are those of the postings."""
    random = np.random.default_rng(3)
    texts = [np.minimum(random.zipf(1.4, 300), 1999).astype(np.uint16) for _ in range(400)]
    idf, lengths = np.maximum(random.normal(2, 1, 2000), 0), np.full(400, 300)
    index = packing.InvertedIndex(texts, lengths, idf, 300.0)
    dense = packing.DenseIndex(index)
    queries_ = [np.unique(t) for t in texts[:100]]
    query, token = np.repeat(np.arange(100), [len(t) for t in queries_]), np.concatenate(queries_).astype(np.int64)
    assert np.allclose(dense.scores(query, token, 100), [index.scores(t) for t in queries_], rtol=1e-4)
    place = np.searchsorted(index.tokens, token)
    held = index.tokens[np.minimum(place, len(index.tokens) - 1)] == token
    rows = dense.rows(dense.row[place[held]], index.count[place[held]], 100)
    assert 0 < rows < len(dense.table) / 4


def test_rests_stand_for_whole_documents(spark):
    """A long text is indexed and asks with all its ids, not those of its rest alone."""
    path = tokens.vocabulary_path()
    ids = packing.encoded(documents(spark, [(1, "alpha " * 500 + "omega"), (2, "beta")]), path)
    row = packing.dealt(ids, 1, tokens.encoder(path).size, 64).collect()[0].asDict()
    part = packing.Shard(row, "<u2")
    assert [len(t) for t in part.texts] == part.doc_tokens.tolist()
    assert part.length.tolist() == [n % 64 for n in part.doc_tokens.tolist()] and part.doc_tokens[0] > 500


@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 1 << 40, 1 << 60, (1 << 64) - 1])
def test_codec_round_trip(high):
    random = np.random.default_rng(3)
    for n in (0, 1, 59, 60, 61, 5000):
        ids = random.integers(0, high, n, dtype=np.uint64)
        words, escapes = simple8b.encode(ids)
        assert np.array_equal(simple8b.decode(words, escapes), ids)
        assert len(escapes) == (ids >= 1 << 60).sum()
    assert len(simple8b.encode(np.zeros(60, np.uint64))[0]) == 1


def test_file_blocks(tmp_path):
    docs = [(7, 10), (None, 0), (8, 250), (9, 1)]
    with open(tmp_path / "x", "wb") as out:
        writer = simple8b.Writer(out, block_ids=64)
        for doc, n in docs:
            writer.add(doc, np.arange(n, dtype=np.uint32))
        writer.close()
    with open(tmp_path / "x", "rb") as stream:
        reader = simple8b.Reader(stream, (tmp_path / "x").stat().st_size)
        assert list(reader.documents()) == [(d, n, crc(range(n))) for d, n in docs]
        assert reader.blocks[:, 1].tolist() == [0, 64, 128, 192, 256]
    (tmp_path / "y").write_bytes((tmp_path / "x").read_bytes()[:-3])
    with open(tmp_path / "y", "rb") as stream, pytest.raises(ValueError):
        simple8b.Reader(stream, (tmp_path / "y").stat().st_size)


def starts(texts, library):
    at, out = 0, []
    for doc, text in texts:
        ids = [*ids_of(library, text), 2]
        out.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_files_query(spark, rows, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    assert rows(queries.op6_simple8b_files(spark, SF_DIR)) == sorted(starts(docs, library), key=repr)


def test_files_odd_rows(spark, rows, library):
    once = [(i, t) for k, (i, t) in enumerate(TEXTS) if i not in {j for j, _ in TEXTS[:k]}]
    ordered = sorted(once, key=lambda r: (r[0] is not None, r[0] or 0))
    found = simple8b.round_trip(documents(spark, once, extra="start"))
    assert rows(found) == sorted(starts(ordered, library), key=repr)


def test_counts_query(spark, rows, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    expected = [(r.doc_id, len(r.text.encode()), n := len(ids_of(library, r.text)), n > 2048) for r in docs]
    assert rows(queries.op8_transducer_counts(spark, SF_DIR)) == sorted(expected, key=repr)


def test_counts_odd_rows(spark, rows, library):
    found = transducer.count_tokens(documents(spark, TEXTS, extra="n_tokens")).select("doc_id", "n_tokens")
    assert rows(found) == sorted(((i, len(ids_of(library, t))) for i, t in TEXTS), key=repr)


def test_chunks_do_not_matter(library, monkeypatch):
    """Chunks down to one character, cuts of long texts, and a new start of the compilation change nothing."""
    texts = [t or "" for _, t in TEXTS if len(t or "") < 20_000]
    plain = [len(ids_of(library, t)) for t in texts]
    for name, value in (
        ("CHUNK", 1), ("CHUNK", 7), ("SEGMENT", 50), ("DENSE", 4), ("MAX_RARE", 10), ("MAX_STATES", 100), ("MAX_STATES", 3),
    ):
        monkeypatch.setattr(transducer, name, value)
        compiled = transducer.Transducer(tokens.vocabulary_path())
        assert compiled.counts(texts).tolist() == plain
        assert compiled.counts(texts).tolist() == plain


def test_counts_of_many_characters(library):
    """20,000 different characters, with and without white space between them."""
    import random

    draw = random.Random(5)
    many = [chr(c) for c in range(0x4E00, 0x4E00 + 20_000)]
    draw.shuffle(many)
    texts = ["".join(many), " ".join("".join(draw.choices(many, k=5)) for _ in range(2000)), "plain words"]
    compiled = transducer.Transducer(tokens.vocabulary_path())
    assert compiled.counts(texts).tolist() == [len(ids_of(library, t)) for t in texts]
    assert compiled.next.shape[1] <= transducer.DENSE


def test_counts_without_white_space(library, monkeypatch):
    """Chunks run from a first entry and are put right from the states before them, in few rounds."""
    import random

    draw = random.Random(6)
    words = "the of and tokens running ed 'll 's 12 --- ... \u00e9\u00df".split()
    texts = ["".join(draw.choices(words, k=4000)), "a" * 9000, "ab" * 5000 + " " + "!?" * 3000, "x'" * 4000, "'" * 5000]
    monkeypatch.setattr(transducer, "CHUNK", 64)
    compiled = transducer.Transducer(tokens.vocabulary_path())
    runs, run = [], compiled._run
    monkeypatch.setattr(compiled, "_run", lambda *a: runs.append(len(a[2])) or run(*a))
    assert compiled.counts(texts[:1]).tolist() == [len(ids_of(library, texts[0]))]
    assert len(runs) <= 8 and sum(runs) < 3 * runs[0]
    assert compiled.counts(texts).tolist() == [len(ids_of(library, t)) for t in texts]


def test_empty_table(spark):
    empty = documents(spark, [])
    assert packing.pack(empty).count() == 0
    assert simple8b.round_trip(empty).count() == 0
    assert transducer.count_tokens(empty).count() == 0
