import numpy as np
import pytest
import xxhash

from tests.llm.helpers import ODD_TEXTS, SF_DIR, documents, lower_ascii, spaced_words
from tidemart.llm import queries, simhash


def plain_fingerprint(text):
    words = spaced_words(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marked, radius=4):
    """Least id of each row's component, by comparing all pairs."""
    top = list(range(len(marked)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, (_, a) in enumerate(marked):
        for j, (_, b) in enumerate(marked[:i]):
            if (a ^ b).bit_count() <= radius:
                top[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(marked):
        least.setdefault(root(i), []).append(doc)
    return [min((d for d in least[root(i)] if d is not None), default=None) for i in range(len(marked))]


def test_query_is_the_brute_force_result(spark, rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    marked = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    expected = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(marked, plain_components(marked))), key=repr)
    assert rows(queries.op2_simhash_vantage(spark, SF_DIR)) == expected
    assert len({c for _, _, c in expected}) < len(expected)


@pytest.mark.parametrize("blocks", [1, 2, 4])
def test_trees_lose_no_link(spark, blocks):
    random = np.random.default_rng(blocks)
    centres = random.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = [int(c) for c in random.integers(0, 1 << 63, 1500, dtype=np.uint64)]
    for c in centres:  # a chain of neighbours at the very radius and one bit beyond it
        for flips in (3, 4, 5):
            x = int(c)
            for _ in range(3):
                for b in random.choice(64, flips, replace=False):
                    x ^= 1 << int(b)
                values.append(x)
    values = sorted({v - (1 << 64) if v >= 1 << 63 else v for v in values})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = dict(simhash.components(simhash.links(frame, leaf_size=64, blocks=blocks)).collect())
    marked = [(v, v % (1 << 64)) for v in values]
    assert [roots.get(v, v) for v in values] == plain_components(marked)


def test_odd_rows(spark, rows):
    texts = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "one"), (None, "one"), (None, "a null id of its own kind")]
    docs = documents(spark, texts, extra="component_id")
    marked = [(i, plain_fingerprint(t)) for i, t in texts]
    found = rows(simhash.near_duplicates(docs).drop("fp"))
    assert found == sorted(((d, c) for (d, _), c in zip(marked, plain_components(marked))), key=repr)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    named = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(named) == sorted({c for d, c in found if d is not None})


def test_each_component_keeps_a_row_of_its_own(spark):
    """One id with two far texts, one of them with a copy: both texts stay."""
    alone, copied = " ".join(f"alpha{k}" for k in range(200)), " ".join(f"omega{k}" for k in range(200))
    kept = simhash.representatives(documents(spark, [(1, alone), (1, copied), (1, copied), (2, copied)]))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, alone), (1, copied)])


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.representatives(documents(spark, [])).count() == 0
