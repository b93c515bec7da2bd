"""Sources and sinks: topics, upserts, dimensions, databases, day files, text files."""

import json

import pytest
from pyspark.sql import functions as F

from tidemart.session import complete_folders, shared_dir, shared_root, shuffle_partitions
from tidemart.sinks import relational
from tidemart.sinks.days import write_day_partitioned
from tidemart.sinks.dims import DimStore, sync_dim_tables
from tidemart.sinks.topics import as_records, write_batch_json
from tidemart.sinks.upsert import UpsertTable, write_upsert
from tidemart.sources import files
from tidemart.sources.cdc import read_cdc
from tidemart.sources.relational import jdbc_options, ods_table
from tidemart.sources.topics import TopicSpec, read_batch

ROW = "id long, ts long, op string, v string"


def test_topic_round_trip(spark, tmp_path, rows):
    topic = TopicSpec("t", folder=f"{tmp_path}/t")
    write_batch_json(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), topic)
    assert rows(read_batch(spark, topic, "a int, b string")) == [(1, None), (2, "x")]
    assert as_records(spark.createDataFrame([("{}",)], "value string")).first().value == "{}"


def test_kafka_options():
    options = TopicSpec("t", servers="h:9092", start="latest").kafka_options()
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "t"
    for bad in (TopicSpec("t", servers="h", start="middle"), TopicSpec("t")):
        with pytest.raises(ValueError):
            bad.kafka_options()


def test_read_cdc_keeps_images_as_text(spark, tmp_path):
    record = {"op": "u", "before": None, "after": {"id": 1, "n": {"x": [1]}}, "source": {"table": "t", "row": 0}, "ts_ms": 5}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "0.txt").write_text(json.dumps(record) + "\n")
    [row] = read_cdc(spark, TopicSpec("c", folder=f"{tmp_path}/c"), stream=False).collect()
    assert json.loads(row.after) == record["after"] and row.before is None
    assert row.source["table"] == "t" and (row.op, row.ts_ms) == ("u", 5)


def test_upsert_replay_delete_and_compaction(spark, tmp_path, rows):
    table = UpsertTable(f"{tmp_path}/t", ["id"], ["ts"], compact_every=0)
    write = lambda data, n: table.append(spark.createDataFrame(data, ROW), n)
    write([(1, 1, "c", "a"), (1, 2, "u", "b"), (2, 1, "c", "c"), (3, 1, "c", "d")], 0)
    write([(2, 5, "d", None), (3, 2, "u", "e")], 1)
    expected = [(1, 2, "b"), (3, 2, "e")]
    assert rows(table.read(spark)) == expected
    write([(2, 5, "d", None), (3, 2, "u", "e")], 1)  # the same batch again
    assert rows(table.read(spark)) == expected
    table.compact(spark)
    table.compact(spark)
    assert complete_folders(spark, f"{tmp_path}/t/base") == [f"{1:020d}"]
    assert rows(table.read(spark)) == expected
    write([(2, 4, "u", "late"), (1, 1, "u", "late")], 2)  # older than what is stored
    assert rows(table.read(spark)) == expected
    write([(2, 6, "c", "again")], 3)
    assert rows(table.read(spark)) == [(1, 2, "b"), (2, 6, "again"), (3, 2, "e")]


def test_upsert_ignores_an_unfinished_folder(spark, tmp_path, rows):
    table = write_upsert(spark.createDataFrame([(1, 1, "c", "a")], ROW), f"{tmp_path}/t", ["id"], ["ts"])
    partial = spark.createDataFrame([(1, 9, "u", "partial")], ROW).withColumn("_batch", F.lit(7).cast("long"))
    partial.write.parquet(f"{tmp_path}/t/changes/{7:020d}")
    (tmp_path / "t" / "changes" / f"{7:020d}" / "_SUCCESS").unlink()
    assert rows(table.read(spark)) == [(1, 1, "a")]


def test_upsert_compacts_by_itself(spark, tmp_path, rows):
    table = UpsertTable(f"{tmp_path}/t", ["id"], compact_every=2)
    for n in range(4):
        table.append(spark.createDataFrame([(1, n), (n + 10, n)], "id long, n long"), n)
    assert complete_folders(spark, f"{tmp_path}/t/base") == [f"{2:020d}"]
    assert rows(table.read(spark)) == [(1, 3), (10, 0), (11, 1), (12, 2), (13, 3)]


def test_dim_store(spark, tmp_path, rows):
    store = DimStore(spark, str(tmp_path), "dims_store_test")
    store.create("dim_a")
    store.create("dim_a")
    assert store.exists("dim_a") and not store.exists("dim_b") and store.list_dims() == ["dim_a"]
    put = lambda data, n: store.write(
        "dim_a", spark.createDataFrame(data, "rowkey string, info map<string,string>"), n)
    put([("k1", {"v": "1"}), ("k2", {"v": "2"})], 0)
    put([("k2", {"v": "3"}), ("k3", {"v": "4"})], 1)
    put([("k2", {"v": "3"}), ("k3", {"v": "4"})], 1)  # the same batch again
    assert {r.rowkey: r.info["v"] for r in store.read("dim_a").collect()} == {"k1": "1", "k2": "3", "k3": "4"}
    assert store.count("dim_a") == 3 and store.scan("dim_a", 2).count() == 2
    assert store.get("dim_a", "k2").first().info == {"v": "3"}
    store.delete("dim_a", spark.createDataFrame([("k1",), ("nope",)], "rowkey string"), "del1")
    assert sorted(r.rowkey for r in store.read("dim_a").collect()) == ["k2", "k3"]
    store.drop("dim_a")
    assert store.list_dims() == []


def test_sync_dim_tables(spark, tmp_path):
    store = DimStore(spark, str(tmp_path), "dims_sync_test")
    conf = lambda sink: json.dumps({"source_table": "s", "sink_table": sink})
    sync = lambda data: sync_dim_tables(store, spark.createDataFrame(
        data, "op string, before string, after string, ts_ms long"))
    sync([("r", None, conf("dim_x"), 1), ("c", None, conf("dim_y"), 2), ("c", None, conf("dim_y"), 3)])
    assert store.list_dims() == ["dim_x", "dim_y"]
    sync([("u", conf("dim_x"), conf("dim_z"), 4), ("d", conf("dim_y"), None, 5)])
    assert store.list_dims() == ["dim_z"]


def test_day_partitions(spark, tmp_path):
    at = {"1700000000": "20231114", "1700000000000": "20231114", '"x"': "error_bucket", "null": "error_bucket"}
    data = [(f'{{"at": {a}}}',) for a in at] + [("{}",), ("{bad",)]
    write_day_partitioned(spark.createDataFrame(data, "value string"), "at", f"{tmp_path}/d")
    got = {r.day: r["count"] for r in spark.read.text(f"{tmp_path}/d").groupBy(F.col("day").cast("string")).count().collect()}
    assert got == {"20231114": 2, "error_bucket": 4}


def test_relational_statements():
    assert relational.merge_statement("t", "s", ["id", "v"], ["id"]) == (
        "INSERT INTO `t` (`id`, `v`) SELECT `id`, `v` FROM `s` ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)")
    assert relational.merge_statement("t", "s", ["id"], ["id"]).startswith("INSERT IGNORE")
    calls = []

    def fails_twice():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no connection")

    relational.with_retries(fails_twice, wait_s=0)
    assert len(calls) == 3
    with pytest.raises(OSError):
        relational.with_retries(lambda: (_ for _ in ()).throw(OSError()), retries=1, wait_s=0)
    assert relational.olap_options("n", "d.t", "u", "p")["sink.max-retries"] == "3"


def test_jdbc_options_and_ods(spark, rows):
    options = jdbc_options("url", "t", "u", "p", split_on="id", bounds=("1", "100"), splits=4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        jdbc_options("url", "t", "u", "p", split_on="id")
    raw = spark.createDataFrame([("7", "p", "x", "2024", "1.005", "z", "c")],
                                "id string, goods_id string, operate_type string, operate_time string, price string, "
                                "stock_num string, operate_content string")
    assert [str(v) for v in ods_table(raw, "ods_goods_operation_log").first()] == [
        "7", "p", "x", "2024", "1.01", "None", "c"]


def test_text_sources(spark, tmp_path, rows):
    (tmp_path / "w.txt").write_text("b\na\n\nb\n")
    assert rows(files.read_words(spark, f"{tmp_path}/w.txt")) == [("a",), ("b",)]
    assert files.first_line(spark, f"{tmp_path}/w.txt") == "b"
    (tmp_path / "j.json").write_text('{"a": 1}\n{"a": 2, "b": 3}\n')
    assert rows(files.read_json_lines(spark, f"{tmp_path}/j.json", "a int")) == [(1,), (2,)]


def test_shared_folder(spark):
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    child = spark.newSession()
    assert shared_root(child) == shared_root(spark)
    assert shuffle_partitions(spark, 100 << 40) == 204_800
    assert shuffle_partitions(spark, 1) == 4 * spark.sparkContext.defaultParallelism
