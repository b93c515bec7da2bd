"""Streams over several ordered files: final state equals the batch form, also across a restart."""

import json
import os

from pyspark.sql import functions as F

from tests.test_operators import brute_is_new, hot_log, hot_times
from tidemart.operators.projections import cdc_image
from tidemart.session import stream_session
from tidemart.sinks.dims import DimStore
from tidemart.sinks.upsert import UpsertTable
from tidemart.sources.topics import TopicSpec
from tidemart.streaming import jobs, stateful
from tidemart.streaming.watermarks import fallback_watermark, json_watermark, list_watermark, watermark


def feed(spark, folder, data, schema, first=0, step=200):
    """Write rows as files named in arrival order."""
    names = [f.split()[0] for f in schema.split(", ")]
    folder.mkdir(exist_ok=True)
    for i in range(0, len(data), step):
        lines = [json.dumps(dict(zip(names, r, strict=True))) for r in data[i:i + step]]
        path = folder / f"{first + i:08d}.json"
        path.write_text("\n".join(lines) + "\n")
        # Files are taken in the order of their times.
        os.utime(path, (1_700_000_000 + first + i,) * 2)


def source(child, folder, schema):
    return child.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def append(df, base, mode="append"):
    jobs.finish(df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint")
                .format("parquet").option("path", f"{base}/rows"))


LOG = "n long, mid string, is_new string, ts long"


def test_fix_is_new_over_batches_and_restart(spark, tmp_path):
    child = stream_session(spark)
    records = hot_log()
    run = lambda: append(stateful.fix_is_new_stream(source(child, tmp_path / "in", LOG), "n"), tmp_path / "out")
    feed(child, tmp_path / "in", records[:400], LOG)
    run()
    feed(child, tmp_path / "in", records[400:], LOG, first=400)
    run()
    got = {r.n: r.is_new for r in child.read.parquet(f"{tmp_path}/out/rows").collect()}
    assert got == brute_is_new(records)


def test_dedup_latest_over_batches(spark, tmp_path):
    """As the batch form, with keys and times that are null, a batch run again, and small chunks."""
    records = [*hot_times(), *[(10_000 + i, None if i % 3 else 77, None if i % 5 == 0 else i % 7) for i in range(40)]]
    records.sort()
    times = stateful.LatestTimes(f"{tmp_path}/t", "key", "ts", buckets=4)
    got, parts = [], [records[i:i + 150] for i in range(0, len(records), 150)]
    for number, part in [*enumerate(parts), (len(parts) - 1, parts[-1])]:
        got = [r for r in got if r[0] < number]
        out = times.keep(spark.createDataFrame(part, "n long, key long, ts long"), number, "n", chunk=50)
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
        got += [(number, tuple(r)) for r in out.select("n", "key", "ts").collect()]
    latest, expected = {}, []
    for n, key, ts in records:
        seen = latest.get(key)
        if seen is None or (ts is not None and ts > seen):
            expected.append((n, key, ts))
            latest[key] = ts
    assert len(parts) > 1 and sorted((r for _, r in got), key=repr) == sorted(expected, key=repr)


def test_latest_times_expire(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "n long, key long, ts long")
    kept = lambda number, ttl, rows: [
        r.n for r in stateful.LatestTimes(f"{tmp_path}/t", "key", "ts", ttl).keep(frame(rows), number, "n").collect()]
    assert kept(0, 3_600_000, [(1, 1, 50)]) == [1]
    assert kept(1, 3_600_000, [(2, 1, 40)]) == []
    assert kept(2, 1, [(3, 1, 40)]) == [3]


def test_bloom_over_batches(spark, tmp_path):
    child = stream_session(spark)
    schema = "order_id long, ts_ms long"
    feed(child, tmp_path / "in", [(i % 250, 1) for i in range(600)], schema)
    append(stateful.dedup_bloom_stream(source(child, tmp_path / "in", schema), expected=500, rate=0.001, shards=2),
           tmp_path / "out")
    ids = [r.order_id for r in child.read.parquet(f"{tmp_path}/out/rows").collect()]
    assert len(ids) == len(set(ids)) and 240 <= len(ids) <= 250


def test_late_row_is_dropped_and_near_row_kept(spark, tmp_path):
    child = stream_session(spark)
    schema = "id long, s long"
    # A batch drops what was late by the watermark of the batch before it.
    data = [(1, 1000), (2, 1002), (3, 999), (5, 1000), (4, 990), (2, 1002)]
    feed(child, tmp_path / "in", data, schema, step=2)
    rows = source(child, tmp_path / "in", schema).withColumn("t", F.timestamp_seconds("s"))
    append(stateful.dedup_exact_stream(rows, ["id"], "t", "5 seconds"), tmp_path / "out")
    assert sorted(r.id for r in child.read.parquet(f"{tmp_path}/out/rows").collect()) == [1, 2, 3, 5]


def test_upsert_stream_restart_counts_once(spark, tmp_path, rows):
    child = stream_session(spark)
    schema = "op string, before string, after string, ts_ms long"
    change = lambda op, i, v, ts: (
        op, json.dumps({"id": i, "v": v}) if op == "d" else None, None if op == "d" else json.dumps({"id": i, "v": v}), ts)
    table = UpsertTable(f"{tmp_path}/t", ["id"], ["ts_ms"])
    run = lambda: jobs.finish(jobs.upsert_stream(
        cdc_image(source(child, tmp_path / "in", schema), "id long, v string"), table, f"{tmp_path}/checkpoint"))
    feed(child, tmp_path / "in", [change("c", i, "a", 1) for i in range(10)], schema, step=5)
    run()
    run()
    feed(child, tmp_path / "in", [change("u", 1, "b", 2), change("d", 2, "a", 3)], schema, first=50)
    run()
    got = {r.id: r.v for r in table.read(child).collect()}
    assert got == {i: "b" if i == 1 else "a" for i in range(10) if i != 2}


def test_aggregate_updates_over_batches(spark, tmp_path):
    child = stream_session(spark)
    schema = ("user_id string, device_id string, visit_type string, event_time timestamp, page_url string, "
              "page_type string, is_follow_shop boolean, proc_time timestamp")
    at = "2024-01-01 00:00:00"
    data = [(f"u{i % 7}", "d", ("new", "return", "purchase")[i % 3], at, "/", "p", i % 2 == 0, at) for i in range(300)]
    feed(child, tmp_path / "in", data, schema, step=100)
    table = UpsertTable(f"{tmp_path}/t", ["user_id", "dt"])
    jobs.finish(jobs.user_visit_stream(source(child, tmp_path / "in", schema), table, f"{tmp_path}/checkpoint"))
    got = {r.user_id: (r.visit_count, r.new_visit_count) for r in table.read(child).collect()}
    assert got == {f"u{u}": (sum(i % 7 == u for i in range(300)), sum(i % 7 == u and i % 3 == 0 for i in range(300)))
                   for u in range(7)}


def test_config_stream_creates_and_drops(spark, tmp_path):
    child = stream_session(spark)
    store = DimStore(child, f"{tmp_path}/store", "dims_stream_test")
    schema = "op string, before string, after string, ts_ms long"
    conf = lambda sink: json.dumps({"source_table": "s", "sink_table": sink})
    feed(child, tmp_path / "in", [("c", None, conf("dim_p"), 1), ("c", None, conf("dim_q"), 2),
                                  ("d", conf("dim_p"), None, 3)], schema, step=2)
    jobs.finish(jobs.config_stream(source(child, tmp_path / "in", schema), store, f"{tmp_path}/checkpoint"))
    assert store.list_dims() == ["dim_q"]


def test_watermark_columns(spark):
    df = spark.createDataFrame([('{"ts_ms": 1500, "timestamp": 2}', ['{"window_start_time": 3000}']), ("{bad", [])],
                               "value string, items array<string>")
    ms = lambda d: [r[0] for r in d.select(F.unix_millis("event_time")).collect()]
    assert ms(json_watermark(df, "ts_ms")) == [1500, 0]
    assert ms(fallback_watermark(df, "5 seconds")) == [2000, None]
    assert ms(list_watermark(df, "items", "5 seconds")) == [3000, None]
    timed = df.withColumn("event_time", F.timestamp_millis(F.lit(1)))
    assert watermark(timed, "event_time").count() == 2


def test_comment_stream_prints(spark, tmp_path):
    child = stream_session(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"ts_ms": 5}\n{bad\n')
    jobs.finish(jobs.comment_stream(child, TopicSpec("c", folder=f"{tmp_path}/in")))


def test_facts_follow_changes_deletes_and_a_repeated_batch(spark, tmp_path):
    """Refund requests with their order: later versions, ties in time, a delete, an order that comes late."""
    import json

    from tidemart.schemas import CDC_ENVELOPE
    from tidemart.streaming import facts

    dic = spark.createDataFrame([("1005", ("1005", "refunding"))], "dic_code string, info struct<dic_code: string, dic_name: string>")
    fact = facts.order_refund(str(tmp_path), lambda: dic)

    def change(table, op, pos, **row):
        text = json.dumps(row)
        return (op, text if op == "d" else None, None if op == "d" else text, {"table": table, "pos": str(pos)}, 1)

    def refund(op, pos, key, order, num):
        return change("order_refund_info", op, pos, id=key, order_id=order, refund_num=num, create_time=1, user_id=1, sku_id=1)

    batches = [
        [refund("c", 1, 1, 10, 5), refund("u", 2, 1, 10, 6), refund("c", 1, 2, 20, 7), change("order_info", "c", 1, id=10, order_status=1005)],
        [change("order_info", "c", 1, id=20, order_status=1005), refund("c", 1, 3, 10, 8)],
        [refund("d", 3, 1, 10, 6), refund("u", 2, 3, 20, 9)],
    ]
    seen = []
    for number, rows in [*enumerate(batches), (2, batches[2])]:
        fact.step(spark.createDataFrame(rows, CDC_ENVELOPE), number)
        seen.append(sorted((r.id, r.order_id, r.refund_num) for r in fact.fact.read(spark).collect()))
    assert seen == [[(1, 10, 6)], [(1, 10, 6), (2, 20, 7), (3, 10, 8)], [(2, 20, 7), (3, 20, 9)], [(2, 20, 7), (3, 20, 9)]]


def test_moved_rows_and_opened_buckets_of_a_fact(spark, tmp_path):
    """A late older version does not bring a moved row back; a batch opens its orders' buckets."""
    import json

    from tidemart.schemas import CDC_ENVELOPE
    from tidemart.streaming import facts

    dic = spark.createDataFrame([("1005", ("1005", "refunding"))], "dic_code string, info struct<dic_code: string, dic_name: string>")
    fact = facts.order_refund(str(tmp_path), lambda: dic, buckets=8)

    def change(table, op, pos, **row):
        return (op, None, json.dumps(row), {"table": table, "pos": str(pos)}, 1)

    def refund(op, pos, key, order, num):
        return change("order_refund_info", op, pos, id=key, order_id=order, refund_num=num, create_time=1, user_id=1, sku_id=1)

    orders = [change("order_info", "c", 1, id=o, order_status=1005) for o in range(1, 41)]
    fact.step(spark.createDataFrame([*orders, *[refund("c", 1, o, o, 1) for o in range(1, 41)]], CDC_ENVELOPE), 0)
    fact.step(spark.createDataFrame([refund("u", 5, 1, 2, 7)], CDC_ENVELOPE), 1)
    fact.step(spark.createDataFrame([refund("u", 3, 1, 1, 6)], CDC_ENVELOPE), 2)
    rows = {(r.id, r.order_id, r.refund_num) for r in fact.fact.read(spark).collect()}
    assert rows == {(1, 2, 7), *[(o, o, 1) for o in range(2, 41)]}
    folders = lambda number: {p.name for p in (tmp_path / "fact/changes" / f"{number:020d}").glob("_bucket=*")}
    assert len(folders(0)) == 8 and 1 <= len(folders(1)) <= 2 and not folders(2)
    near = fact.fact.touched(spark.createDataFrame([(1,), (2,)], "order_id long"))
    opened = fact.states["order_info"].read(spark, near=near).inputFiles()
    assert 1 <= len({f.rsplit("_bucket=", 1)[1].split("/")[0] for f in opened}) <= 2


def test_topic_files_and_tasks_stay_small(spark, tmp_path, monkeypatch):
    """A compressed file is read by one task, so no file of a topic grows with what is written; a stream's shuffles and reads are not fewer than a batch's."""
    from tidemart.session import INITIAL, configure, shuffle_partitions
    from tidemart.sinks import topics

    monkeypatch.setattr(topics, "FILE_RECORDS", 10)
    records = spark.range(95).select(F.col("id").cast("string").alias("value")).coalesce(1)
    topics.write_batch_json(records, TopicSpec("t", folder=f"{tmp_path}/plain"))
    topics.write_batch_json(records, TopicSpec("t", folder=f"{tmp_path}/parts"), F.col("value").cast("int") % 2)
    assert len(list((tmp_path / "plain").glob("*.gz"))) == 10
    assert len(list((tmp_path / "parts" / "part=0").glob("*.gz"))) == 5
    child = configure(stream_session(spark))
    assert child.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    assert int(child.conf.get(INITIAL)) == shuffle_partitions(spark, 0)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
