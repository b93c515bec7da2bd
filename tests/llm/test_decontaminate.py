import hashlib
import re

import pytest

from tests.llm.helpers import ODD_TEXTS, documents, lower_ascii
from tidemart.llm import decontaminate as D

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven"), (2, "One, two!"), (10, None), (11, " -- "),
    (2, "one TWO"), (None, "ärger über"), (12, "zero one two three four five six seven eight nine ten"),
]
TEXTS = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [
    (100, "Say: ONE two three-four five six seven eight nine TEN, and then some"), (101, "one one two two"), (101, "one one two two"),
    (None, "x one two three four five six seven eight nine ten eleven y one two"), (102, "Ärger über ärger über"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def plain(texts, items, size=10):
    windows = set()
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        windows |= {(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1) if n}
    for doc, text in texts:
        w, hit, found = words(text), set(), set()
        for item, gram in windows:
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i:i + len(gram)]) == gram:
                    hit |= {*range(i, i + len(gram))}
                    found |= set() if item is None else {str(item)}
        yield doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("max_bytes", [D.MAX_BROADCAST_BYTES, 300])
def test_odd_rows_whole_and_in_blocks(spark, rows, max_bytes):
    docs = documents(spark, TEXTS, extra="n_hit")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.decontaminate(docs, items, max_bytes=max_bytes)
    found = found.select("doc_id", "n_words", "n_hit", "n_items", D.items_digest(), "contaminated")
    assert rows(found) == sorted(plain(TEXTS, ITEMS), key=repr)


def test_cleaned_texts(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    passage = "One two, three four five six seven eight nine TEN"
    filler = "quite other words that nobody asks for " * 3
    docs = documents(spark, [(1, f"Before. {passage} after; {filler}"), (2, passage + " eleven"), (3, "clean"), (4, None)], extra="n_words")
    out = D.cleaned(docs, items)
    assert out.columns == docs.columns
    cut = f"Before.  after; {filler}"
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert texts == {1: (cut, len(cut)), 3: ("clean", 5), 4: (None, 0)}


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.decontaminate(documents(spark, []), items).count() == 0
    assert D.decontaminate(documents(spark, [(1, "one two")]), items.limit(0)).filter("contaminated").count() == 0
