"""Routing as of a record's own place, against a replay in log order."""

import hashlib
import json

from tidemart.schemas import CDC_ENVELOPE
from tidemart.session import stream_session
from tidemart.sinks.dims import DimStore
from tidemart.streaming.dims import DimsJob


def config(op, source, old, new, ts, pos=0, columns=""):
    image = lambda sink: sink and json.dumps({
        "source_table": source, "sink_table": sink, "sink_columns": columns, "sink_family": "info", "sink_row_key": "id"})
    return (op, image(old), image(new), {"table": "table_process_dim", "pos": str(pos)}, ts)


def record(table, key, name, ts, pos=0, op="u"):
    row = json.dumps({"id": key, "name": name, "more": None})
    return (op, row if op == "d" else None, None if op == "d" else row, {"table": table, "pos": str(pos)}, ts)


BATCHES = [
    [config("r", "a", None, "dim_a", 1), config("c", "b", None, "dim_b", 1), record("a", 1, "one", 10), record("b", 7, "seven", 10),
     record("c", 1, "no rule", 10), (None, "?", "?", None, 5), ("x", None, "{}", {"table": "a"}, 6)],
    # In one batch: a moves between two places of one millisecond, b's table goes and comes back.
    [record("a", 1, "late one", 20, 1), config("u", "a", "dim_a", "dim_a2", 20, 2), record("a", 2, "two", 20, 3), record("a", 2, "older", 20, 2),
     record("b", 8, "lost", 21), config("d", "b", "dim_b", None, 22), record("b", 9, "no rule now", 23), config("c", "b", None, "dim_b", 24),
     record("b", 10, "ten", 25), record("b", 10, "gone", 26, op="d")],
    [record("a", 3, "three", 30), record("a", 1, "of the old place", 15), record("b", 11, "eleven", 30), config("d", "a", "dim_a2", None, 40)],
]


def replay(batches):
    """(routed, tables) if config and records are handled one by one in log order."""
    log = sorted((r for b in batches for r in b if r[0] in ("r", "c", "u", "d") and r[3]), key=lambda r: (r[4], int(r[3]["pos"]), r[3]["table"] != "table_process_dim"))
    rules, tables, routed = {}, {}, []
    for op, before, after, source, _ in log:
        image = json.loads(before if op == "d" else after)
        if source["table"] == "table_process_dim":
            if op != "r" and op != "c":
                tables.pop(json.loads(before)["sink_table"], None)
            if op != "d":
                tables.setdefault(image["sink_table"], {})
            rules.pop(image["source_table"], None)
            if op != "d":
                rules[image["source_table"]] = image
        elif op != "d" and source["table"] in rules:
            sink = rules[source["table"]]["sink_table"]
            key = hashlib.md5(str(image["id"]).encode()).hexdigest()
            tables[sink][key] = image["name"]
            routed.append((sink, key, image["name"]))
    return sorted(routed), tables


def test_batches_follow_the_log(spark, tmp_path):
    child = stream_session(spark)
    store = DimStore(child, str(tmp_path / "store"), "dims_job_test")
    job = DimsJob(store, str(tmp_path / "job"))
    try:
        for number, batch in enumerate(BATCHES):
            frame = child.createDataFrame(batch, CDC_ENVELOPE).repartition(3)
            job.step(frame, number)
            if number == 1:
                job.step(frame, number)  # again, as after a failure
            routed, tables = replay(BATCHES[:number + 1])
            got = child.read.parquet(str(tmp_path / "job/routed")).selectExpr("sink_table", "rowkey", "info['name'] AS name").collect()
            if number < 2:  # the record of the last batch that comes late is decided after its sink went
                assert sorted(tuple(r) for r in got) == routed
            assert {t: {r.rowkey: r["info"]["name"] for r in store.read(t).collect()} for t in store.list_dims()} == tables
        assert child.read.parquet(str(tmp_path / "job/dirty")).count() == 2
    finally:
        store.drop_all()
