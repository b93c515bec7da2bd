"""The pipeline's stages, each held against a brute-force version on its own input."""

import re
from pathlib import Path

import corpus_pipeline
from tests.llm.helpers import SF_DIR, documents
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_quality import plain_counts
from tests.llm.test_secrets import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tidemart.llm import packing
from tidemart.llm.common import released


def test_stages_over_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "lexical_packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "lexical_packing":
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert len(after) == docs.count() and set(after) <= set(before)
        if name == "quality_rules":
            assert not any(plain_counts(t)[-1] for t in after.values())
            assert all(after[d] == before[d] for d in after)
        elif name == "near_duplicates":
            marked = sorted((d, plain_fingerprint(t)) for d, t in before.items())
            assert set(after) == set(plain_components(marked))
        elif name == "benchmark_decontamination":
            hits = {h[0]: h for h in plain_hits(list(before.items()), items)}
            assert set(after) == {d for d, n, hit, *_ in hits.values() if hit <= 0.5 * n}
            assert all(after[d] == before[d] for d in after if not hits[d][2])
            assert not any(h[2] for h in plain_hits([x for x in after.items() if hits[x[0]][2]], items) if h[2] > hits[h[0]][2])
        else:
            assert set(after) == set(before)
            assert all(after[d] == before[d] for d in before if not plain_spans(before[d])[1])
            assert not any(re.search("AKIA[A-Z0-9]{14,}", t) for t in after.values())
        before = after
    assert {r.doc_id for r in docs.collect()} == set(before)
    assert docs.agg({"length": "sum"}).first()[0] == packing.encoded(
        documents(spark, list(before.items())), packing.vocabulary_path()).selectExpr("sum(length(ids)) / 2").first()[0]


def test_run_gives_pieces_of_the_kept_documents(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_stages_on_odd_and_empty_tables(spark):
    odd = documents(spark, [(1, None), (2, ""), (None, None), (None, "word " * 30), (3, "x"), (3, "x")])
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_DIR).collect()


def test_a_task_gives_its_memory_back():
    """What a task freed below a block still in use goes back to the system when the task ends."""
    pins = []

    def resident():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    def run():
        held = [bytearray(60_000) for _ in range(4000)]
        pins.append(bytearray(60_000))
        yield len(held)

    rows = released(run())
    assert next(rows) == 4000
    during = resident()
    assert list(rows) == [] and pins
    assert resident() < during - 150
