"""What jobs read, shuffle and write must stay in proportion to their input."""

import glob
import gzip
import json

from pyspark.sql import functions as F

import tidemart.checks.capture  # noqa: F401
from tidemart.inputs import derive
from tidemart.schemas import CDC_ENVELOPE
from tidemart.session import stream_session
from tidemart.sinks.topics import write_batch_json
from tidemart.sources.cdc import read_cdc
from tidemart.sources.topics import TopicSpec
from tidemart.streaming import facts, jobs

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topic_files_are_compressed_and_parts_need_no_shuffle(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "repeat('x', 100) AS text")
    write_batch_json(rows, TopicSpec("t", folder=f"{tmp_path}/t"), F.pmod("id", F.lit(3)))
    found = {}
    for part in range(3):
        files = glob.glob(f"{tmp_path}/t/part={part}/*.txt.gz")
        found[part] = [json.loads(line)["id"] for f in files for line in gzip.open(f, "rt")]
    assert {n % 3 for n in found[1]} == {1} and sorted(sum(found.values(), [])) == list(range(100))
    assert [r.id for r in spark.read.text(f"{tmp_path}/t/part=2").select(F.from_json("value", "id long").alias("r")).select("r.id").limit(1).collect()]


def test_versions_of_a_table_are_made_in_one_pass(spark):
    for table, sources in (("order_detail", 1), ("order_detail_coupon", 1), ("cart_info", 1), ("sku_info", 1), ("order_info", 2)):
        assert plan(derive.cdc_feed(spark, SMALL, table, versions=True)).count("FileScan") == sources


def test_fact_states_keep_what_the_fact_needs(spark, tmp_path):
    """A fact over two logs that follow one another, under two checkpoints; no state has the other columns."""
    child = stream_session(spark)
    dic = spark.createDataFrame([("1005", ("1005", "refunding"))], "dic_code string, info struct<dic_code: string, dic_name: string>")
    fact = facts.order_refund(f"{tmp_path}/fact", lambda: dic, buckets=2)

    def change(table, pos, **row):
        return ("c", None, json.dumps(row), {"table": table, "pos": str(pos)}, 1)

    logs = [
        [change("order_info", 1, id=1, order_status=1005, province_id=3, consignee="somebody"),
         change("order_refund_info", 1, id=7, order_id=1, refund_num=5, create_time=1, user_id=1, sku_id=1)],
        [change("order_refund_info", 2, id=7, order_id=1, refund_num=6, create_time=1, user_id=1, sku_id=1)],
    ]
    for n, log in enumerate(logs):
        topic = TopicSpec("changes", folder=f"{tmp_path}/topic/part={n}")
        write_batch_json(spark.createDataFrame(log, CDC_ENVELOPE), topic)
        jobs.finish(fact.stream(read_cdc(child, topic), f"{tmp_path}/checkpoint/{n}", first=n))
    assert [(r.id, r.refund_num, r.province_id) for r in fact.fact.read(child).collect()] == [(7, 6, 3)]
    assert set(fact.states["order_info"].read(child).columns) == {
        "id", "user_id", "province_id", "order_status", "operate_time", "ts_ms", "pos"}


def test_retained_state_stays_in_the_jvm(spark, tmp_path):
    """A join's state, and that of sums without a time to live, needs no Python call per key."""
    from tests.test_streaming import source
    from tidemart.streaming import retention

    child = stream_session(spark)
    for side in ("left", "right"):
        (tmp_path / side).mkdir()
    left, right = source(child, tmp_path / "left", "id long, k long"), source(child, tmp_path / "right", "o long, name string")
    frames = [retention.retained_join(left, right, ["k"], ["o"], ttl) for ttl in (None, 1000)]
    frames.append(retention.retained_totals(left, ["k"], {"n": ("sum", F.col("id"))}))
    assert not any("Pandas" in f._jdf.queryExecution().analyzed().toString() for f in frames)


def test_few_orders_are_picked_before_lines_are_widened(spark):
    """J1 widens the lines of cancelled orders only, J5 those that were paid."""
    from tidemart.checks.registry import QUERIES

    child = spark.newSession()
    child.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert plan(QUERIES["j1_order_cancel"](child, SMALL)).count("Exchange hashpartitioning(") <= 7
    paid = plan(QUERIES["j5_payment_success"](child, SMALL))
    assert paid.index("_act#") < paid.index("Generate explode")


def test_a_bloom_filter_takes_a_bit_a_bit():
    import tracemalloc

    import numpy as np

    from tidemart.operators.dedup import GrowingBloom

    keys = np.random.default_rng(1).integers(0, 1 << 62, (200_000, 2))
    bloom = GrowingBloom(200_000, 0.01)
    tracemalloc.start()
    kept = bloom.keep(keys[:, 0], keys[:, 1])
    again = GrowingBloom.unpacked(bloom.packed())
    assert not again.keep(keys[:, 0], keys[:, 1]).any() and kept.sum() >= 0.99 * len(keys)
    bits = sum(size for _, size, _ in bloom.layers)
    assert sum(layer[0].nbytes for layer in bloom.layers) <= bits / 8 + len(bloom.layers)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()


def test_split_outputs_read_repaired_records(spark):
    """P14's outputs share one pass over the raw records."""
    import tidemart.checks.applog  # noqa: F401
    from tidemart.checks.registry import QUERIES

    split = plan(QUERIES["p14_split_log"](spark, SMALL))
    assert "events.parquet" not in split and "split-log" in split


def _refunds(spark, tmp_path, buckets=4):
    dic = spark.createDataFrame([("1005", ("1005", "refunding"))], "dic_code string, info struct<dic_code: string, dic_name: string>")
    fact = facts.order_refund(f"{tmp_path}/fact", lambda: dic, buckets=buckets)

    def change(table, op, pos, **row):
        text = json.dumps(row)
        return (op, text if op == "d" else None, None if op == "d" else text, {"table": table, "pos": str(pos)}, 1)

    def refund(op, pos, key, order, num):
        return change("order_refund_info", op, pos, id=key, order_id=order, refund_num=num, create_time=1, user_id=1, sku_id=1)

    def step(number, *rows):
        fact.step(stream_session(spark).createDataFrame(list(rows), CDC_ENVELOPE), number)
        return sorted((r.id is None, r.id, r.order_id, r.refund_num) for r in fact.fact.read(spark).collect())

    return fact, change, refund, step


def test_a_fact_writes_the_rows_that_changed(spark, tmp_path):
    """Rows of a touched order that stay as they were are not written again; a row without an id is a row like any other."""
    fact, change, refund, step = _refunds(spark, tmp_path)
    order = change("order_info", "c", 1, id=1, order_status=1005)
    assert len(step(0, order, *[refund("c", 1, n, 1, n) for n in (1, 2, 3, None)])) == 4
    rows = step(1, refund("u", 2, 1, 1, 9), refund("d", 2, 2, 1, 2))
    assert rows == [(False, 1, 1, 9), (False, 3, 1, 3), (True, None, 1, None)]
    assert sorted((r.id, r.op) for r in fact.fact.batch(spark, 1).collect()) == [(1, "u"), (2, "d")]


def test_a_fact_caches_no_records_and_leaves_nothing_aside(spark, tmp_path, monkeypatch):
    """Change records are read by one job of a micro-batch and are not cached; what is laid aside goes with the batch."""
    cached, frame = [], type(spark.range(0))
    monkeypatch.setattr(frame, "persist", lambda self, *a: cached.append(self) or self)
    monkeypatch.setattr(frame, "cache", lambda self: cached.append(self) or self)
    fact, change, refund, step = _refunds(spark, tmp_path)
    child = stream_session(spark)
    topic = TopicSpec("changes", folder=f"{tmp_path}/topic")
    rows = [change("order_info", "c", 1, id=1, order_status=1005), refund("c", 1, 7, 1, 5)]
    write_batch_json(spark.createDataFrame(rows, CDC_ENVELOPE), topic)
    jobs.finish(fact.stream(read_cdc(child, topic), f"{tmp_path}/checkpoint"))
    assert [(r.id, r.refund_num) for r in fact.fact.read(child).collect()] == [(7, 5)]
    assert not cached and not glob.glob(f"{tmp_path}/fact/laid/*")


def test_a_fact_is_joined_in_rounds_of_buckets(spark, tmp_path, monkeypatch):
    """Large states are joined some buckets at a time, with the same rows."""
    seen = {}
    for size in (1 << 40, 1):
        monkeypatch.setattr(facts, "ROUND_BYTES", size)
        fact, change, refund, step = _refunds(spark, tmp_path / str(size))
        orders = [change("order_info", "c", 1, id=o, order_status=1005) for o in range(30)]
        step(0, *orders, *[refund("c", 1, n, n % 30, 1) for n in range(60)])
        seen[size] = step(1, *[refund("u", 2, n, n % 29, 2) for n in range(0, 60, 3)], refund("d", 2, 1, 1, 1))
        assert len(fact._rounds(spark, [0, 1, 2, 3])) == (4 if size == 1 else 1)
    assert seen[1] == seen[1 << 40] and len(seen[1]) == 59


def test_a_topic_is_written_without_sorting_by_part(spark, tmp_path, monkeypatch):
    """Sorting would put all records of a task on its disk; the session's setting comes back."""
    found, frame = [], type(spark.range(0))
    write = frame.write
    monkeypatch.setattr(frame, "write", property(
        lambda self: found.append(self.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")) or write.fget(self)))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    write_batch_json(spark.range(10).selectExpr("id"), TopicSpec("t", folder=f"{tmp_path}/t"), F.pmod("id", F.lit(3)))
    assert int(found[0]) >= 3 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == before


def test_streams_let_go_of_what_a_job_shuffled(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert stream_session(spark).conf.get(name) == "true"


def test_lines_of_a_state_are_shuffled_once_for_the_order(spark):
    """Their activity and coupon come to them where they lie."""
    from tidemart.checks.registry import QUERIES

    child = spark.newSession()
    child.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert plan(QUERIES["dwd_order_detail"](child, SMALL)).count("Exchange hashpartitioning(") <= 10


def _commits(spark, tmp_path, monkeypatch, name):
    """The micro-batches a registered stream took over the smallest tables."""
    from tidemart.checks import load_all

    queries = load_all()[0]
    from tidemart.checks import streams

    monkeypatch.setattr(streams, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    assert queries[name](spark, SMALL).count() > 0
    return sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{tmp_path}/*/checkpoint/commits/*"))


def test_feeds_of_a_retained_join_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Several micro-batches without dealing rows out anew, whatever the size; state is kept small on disk."""
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "repartition", lambda self, *a: (_ for _ in ()).throw(AssertionError("shuffled")))
    assert _commits(spark, tmp_path, monkeypatch, "t5_stream_order_cancel") == ["0", "1", "2"]
    child = stream_session(spark)
    assert {child.conf.get(f"spark.sql.streaming.stateStore.{name}") for name in ("rocksdb.compression", "compression.codec")} == {"zstd"}


def test_an_inner_join_of_streams_takes_no_batch_without_data(spark, tmp_path, monkeypatch):
    assert _commits(spark, tmp_path, monkeypatch, "j5_stream_payment_success") == ["0"]
