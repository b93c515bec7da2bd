"""Operators on literal rows; keyed ones against brute force, with one hot key."""

import json
import random

from pyspark.sql import functions as F

from tidemart.inputs import derive
from tidemart.operators import aggregates, dedup, joins, projections, quality, routing
from tidemart.operators.latest import current_rows, latest_n, latest_per_key
from tidemart.operators.routing import (
    cdc_route, clean_cdc, current_config, log_keys, parse_json, put_is_new, route_dims, split_log, split_rows,
    with_fields,
)
from tidemart.plans.applog import log_split
from tidemart.schemas import ODS_COLUMNS

SF_DIR = "/root/testdata/sf0.001"


# -- golden fixture --------------------------------------------------------------

def test_new_old_users_golden(spark, rows):
    days = {101: (1, 2, 3), 102: (1, 3), 103: (2, 3), 104: (2,), 105: (3,), 106: (1,)}
    log = spark.createDataFrame(
        [(u, f"d_{u}", f"2023-10-0{d}") for u, ds in days.items() for d in ds], "user_id int, device_id string, d string"
    ).withColumn("login_date", F.to_date("d"))
    got = [(str(r[0]), r[1], r[2]) for r in aggregates.new_old_users(log).collect()]
    assert got == [("2023-10-01", 3, 0), ("2023-10-02", 2, 1), ("2023-10-03", 1, 3)]


# -- projections ---------------------------------------------------------------------

def test_schema_from_names():
    kinds = {f.name: f.dataType.simpleString() for f in projections.schema_from_names(
        ["order_id", "id", "stock_num", "pay_time", "pay_amount", "price", "is_paid", "goods_id", "time_amount"])}
    assert kinds == {"order_id": "int", "id": "int", "stock_num": "int", "pay_time": "string",
                     "pay_amount": "decimal(10,2)", "price": "decimal(10,2)", "is_paid": "boolean",
                     "goods_id": "string", "time_amount": "string"}
    assert len(ODS_COLUMNS) == 7


def test_flags_camel_and_json(spark, rows):
    df = spark.createDataFrame([("new",), ("return_no_buy",), ("purchase",), (None,)], "visit_type string")
    assert rows(projections.behavior_flags(df)) == sorted([
        ("new", True, False, False), ("return_no_buy", False, True, False), ("purchase", False, False, True),
        (None, None, None, None)], key=repr)
    renamed = projections.rename_snake_to_camel(spark.createDataFrame([(1, 2)], "SINK_TABLE int, op int"))
    assert renamed.columns == ["sinkTable", "op"]
    assert projections.row_to_json(spark.createDataFrame([(1, None)], "a int, b string")).first()[0] == '{"a":1,"b":null}'


def test_cdc_after_and_clean(spark, rows):
    df = spark.createDataFrame(
        [("c", None, '{"id":"1"}'), ("d", '{"id":"2"}', None)], "op string, before string, after string")
    assert rows(projections.cdc_after(df, "id string")) == [("1",)]
    df = spark.createDataFrame([("u", "b", "a"), ("d", "b", "a")], df.schema)
    assert rows(clean_cdc(df)) == [("d", "b", None), ("u", None, "a")]
    feed = spark.createDataFrame([("c", {"table": "x"}), ("c", {"table": "y"}), ("c", None)],
                                 "op string, source map<string,string>")
    assert cdc_route(feed, "x").count() == 1


# -- latest per key -------------------------------------------------------------------

def test_latest_reduces_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "c", "a"), (1, 2, "u", "b"), (2, 1, "c", "c"), (2, 3, "d", None), (3, None, "c", "d")],
        "id int, ts int, op string, v string")
    assert rows(latest_per_key(df, ["id"], ["ts"]).select("id", "v")) == [(1, "b"), (2, None), (3, "d")]
    assert rows(current_rows(df, ["id"], ["ts"]).select("id", "v")) == [(1, "b"), (3, "d")]
    plan = latest_per_key(df, ["id"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]
    assert [r.id for r in latest_n(df, "ts", 2, ["id"]).collect()] == [2, 1]


# -- application log --------------------------------------------------------------------

RECORDS = [
    '{"common":{"mid":"a","is_new":"1"},"err":{"c":1},"start":{"s":1},"displays":[{"i":1}],"ts":1}',
    '{"common":{"mid":"a","is_new":"0"},"err":{"c":2},"page":{"p":1},"ts":2}',
    '{"common":{"mid":"b"},"page":{"p":2},"displays":[],"actions":[{"x":1},{"x":2}],"ts":3}',
    '{"page":{"p":3},"displays":[{"i":7}],"err":null,"extra":{"k":"v"},"ts":4}',
    "{bad",
    "[1]",
]


def test_split_log(spark):
    raw = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    good, dirty = parse_json(raw)
    assert sorted(r.value for r in dirty.collect()) == ["[1]", "{bad"]
    parts = {n: sorted((json.loads(r.value) for r in df.collect()), key=repr) for n, df in split_log(good).items()}
    assert parts["err"] == [{"c": 1}, {"c": 2}]
    assert parts["start"] == [{"common": {"mid": "a", "is_new": "1"}, "start": {"s": 1}, "displays": [{"i": 1}], "ts": 1}]
    assert parts["display"] == [{"page": {"p": 3}, "display": {"i": 7}, "ts": 4}]
    common, page = {"mid": "b"}, {"p": 2}
    assert parts["action"] == [{"common": common, "page": page, "action": {"x": n}} for n in (1, 2)]
    assert sorted(parts["page"], key=lambda r: r["ts"]) == [
        {"common": {"mid": "a", "is_new": "0"}, "page": {"p": 1}, "ts": 2},
        {"common": common, "page": page, "displays": [], "ts": 3},
        {"page": {"p": 3}, "err": None, "extra": {"k": "v"}, "ts": 4},
    ]
    context = split_log(good, keep_context=True)
    assert all("common" in json.loads(r.value) for r in context["err"].collect())
    assert all(json.loads(r.value)["ts"] == 3 for r in context["action"].collect())


def test_split_rows_equals_split_log(spark, rows):
    raw = with_fields(spark.createDataFrame([(r,) for r in RECORDS], "value string"))
    got = rows(split_rows(raw))
    good, dirty = parse_json(raw.select("value"))
    expected = [(n, r.value) for n, df in split_log(good).items() for r in df.collect()]
    expected += [("dirty", r.value) for r in dirty.collect()]
    assert got == sorted(expected, key=repr)


def test_put_is_new_keeps_the_rest(spark):
    raw = with_fields(spark.createDataFrame([(RECORDS[0], "0"), (RECORDS[1], "0")], "value string, is_new string"))
    got = [json.loads(r[0]) for r in put_is_new(raw).select(F.to_json("fields")).collect()]
    assert [g["common"] for g in got] == [{"mid": "a", "is_new": "0"}] * 2
    assert got[0]["displays"] == [{"i": 1}] and list(got[0]) == sorted(got[0])


def brute_is_new(records):
    first, out = {}, {}
    for n, mid, is_new, ts in sorted(records):
        day = ts // 86_400_000
        first.setdefault(mid, day if is_new == "1" else day - 1)
        out[n] = "0" if is_new == "1" and first[mid] != day else is_new
    return out


def hot_log(n=600, seed=3):
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.4 else f"m{rng.randrange(40)}", rng.choice("01"),
             rng.randrange(5) * 86_400_000 + i) for i in range(n)]


def test_fix_is_new_brute_force(spark):
    records = hot_log()
    df = spark.createDataFrame(records, "n long, mid string, is_new string, ts long").repartition(5)
    got = {r.n: r.is_new for r in dedup.fix_is_new(df, "n").collect()}
    assert got == brute_is_new(records)


def test_log_split_repairs(spark):
    day = 86_400_000
    raw = spark.createDataFrame(
        [(n, json.dumps({"common": {"mid": "a", "is_new": "1"}, "page": {}, "ts": ts}))
         for n, ts in ((1, 5), (2, 6), (3, day + 5))] + [(4, "{bad")], "n long, value string")
    got = {r.n: r for r in log_split(raw, "n", ("n",)).collect()}
    assert [json.loads(got[n].value)["common"]["is_new"] for n in (1, 2, 3)] == ["1", "1", "0"]
    assert (got[4].output, got[4].value) == ("dirty", "{bad")


# -- deduplication -----------------------------------------------------------------------

def brute_latest(records):
    seen, kept = {}, []
    for n, key, ts in sorted(records, key=lambda r: r[0]):
        if key not in seen or ts > seen[key]:
            seen[key] = ts
            kept.append((n, key, ts))
    return sorted(kept)


def hot_times(n=800, seed=5):
    rng = random.Random(seed)
    return [(i, 0 if rng.random() < 0.4 else rng.randrange(1, 30), rng.randrange(100_000)) for i in range(n)]


def test_dedup_latest_brute_force(spark, rows):
    records = hot_times()
    df = spark.createDataFrame(records, "n long, key long, ts long").repartition(5)
    for chunk in (1, 7, 100, 10_000):
        assert sorted(tuple(r) for r in dedup.dedup_latest(df, "key", "ts", "n", chunk).collect()) == brute_latest(records)


def test_dedup_exact_and_bloom(spark, rows):
    df = spark.range(4000).select((F.col("id") % 1500).alias("order_id"), F.lit(1).cast("long").alias("ts_ms"))
    assert dedup.dedup_exact(df).count() == 1500
    kept = dedup.dedup_bloom(df, expected=1000, rate=0.001, approximate=True, shards=3)
    ids = [r.order_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 1470 <= len(ids) <= 1500
    assert dedup.bloom_size(1000, 0.01)[1] == 7


# -- joins ---------------------------------------------------------------------------------

def test_interval_join_brute_force(spark):
    rng = random.Random(1)
    day = 86_400
    left = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", rng.randrange(200 * day)) for i in range(150)]
    right = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", rng.randrange(200 * day)) for i in range(300)]
    # Exact edges of the interval belong to it, one second beyond does not.
    left.append((900, "edge", 100 * day))
    right += [(900, "edge", 70 * day), (901, "edge", 100 * day + 30), (902, "edge", 70 * day - 1),
              (903, "edge", 100 * day + 31)]
    lo, hi = -30 * day, 30
    expected = sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and lo <= b[2] - a[2] <= hi)
    ldf = spark.createDataFrame(left, "l long, lk string, s long").select("l", "lk", F.timestamp_seconds("s").alias("lt"))
    rdf = spark.createDataFrame(right, "r long, rk string, s long").select("r", "rk", F.timestamp_seconds("s").alias("rt"))
    got = joins.interval_join(ldf, rdf, "lk", "rk", "lt", "rt", lo, hi)
    assert sorted((x.l, x.r) for x in got.collect()) == expected
    assert {(900, 900), (900, 901)} <= set(expected) and not {(900, 902), (900, 903)} & set(expected)


def test_keyed_join_splits_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "16",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("n"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        per_key = facts.groupBy(F.col("key").alias("_key")).agg(F.min("n").alias("first"))
        joined = joins.keyed_join(facts, per_key, ["key"], ["_key"], "left")
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 60_000 and all(r.first is not None for r in rows)
        assert "isSkew=true" in plan or "skew=true" in plan.replace(" ", "")
        # Without the second key the aggregate needs no exchange and nothing is split.
        plain = facts.join(per_key, F.col("key") == F.col("_key"), "left")
        plain.collect()
        assert "skew=true" not in plain._jdf.queryExecution().executedPlan().toString().replace(" ", "")
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_left_join_keeps_null_keys_and_missing(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k2 string, v int")
    assert rows(joins.keyed_join(left, right, ["k"], ["k2"], "left").select("id", "v")) == [(1, 10), (2, None), (3, None)]


def dic(spark, pairs):
    return spark.createDataFrame([(c, (c, n)) for c, n in pairs],
                                 "dic_code string, info struct<dic_code:string,dic_name:string>")


def test_lookups(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, code string")
    dim = dic(spark, [("x", "X")])
    assert rows(joins.lookup_join(df, dim, "code")) == [(1, "x", "X")]
    assert rows(joins.lookup_join(df, dim, "code", how="left", default="?")) == [(1, "x", "X"), (2, "y", "?"), (3, None, "?")]
    hashed = dim.select(F.md5("dic_code").alias("rowkey"), "info")
    assert rows(joins.hashed_lookup(df, hashed, "code")) == [(1, "x", "X"), (2, "y", "N/A"), (3, None, "N/A")]


def test_merge_segments_keeps_every_day(spark, rows):
    frame = lambda name, days: spark.createDataFrame([(d, i) for i, d in enumerate(days)], f"dt string, {name} int")
    merged = joins.merge_segments([frame("a", "x"), frame("b", "y"), frame("c", "yz")], "dt")
    assert rows(merged) == [("x", 0, None, None), ("y", None, 0, 0), ("z", None, None, 1)]


def test_customer_analysis_forms_agree(spark, rows):
    rng = random.Random(2)
    visit = spark.createDataFrame(
        [(f"u{u}", f"d{d}", rng.randrange(2), rng.randrange(2), rng.randrange(2)) for u in range(40) for d in range(6)],
        "user_id string, dt string, new_visit_count long, return_visit_count long, purchase_visit_count long")
    pay = spark.createDataFrame(
        [(f"u{u}", f"d{d}", 1 + rng.randrange(3), float(rng.randrange(100))) for u in range(0, 40, 3) for d in range(6)],
        "user_id string, dt string, payment_count long, a double",
    ).select("user_id", "dt", "payment_count", F.col("a").cast("decimal(20,2)").alias("payment_amount"))
    one, other = aggregates.customer_analysis(visit, pay), aggregates.customer_analysis_by_join(visit, pay)
    assert one.columns == other.columns and rows(one) == rows(other)
    only_old = visit.filter("dt = 'd0'").withColumns({"new_visit_count": F.lit(0), "return_visit_count": F.lit(0)})
    row = aggregates.customer_analysis(only_old, pay).first()
    assert row.new_customer_count is None and float(row.new_customer_conversion_rate) == 0.0


def test_dashboard_without_payments(spark, rows):
    empty = spark.createDataFrame([], "pay_amount decimal(10,2), user_id string, dt string")
    assert rows(aggregates.dashboard(empty)) == [("today_customer_count", "0"), ("today_order_count", "0")]


# -- words and config -------------------------------------------------------------------------

def test_flag_sensitive(spark, rows):
    words = spark.createDataFrame([("bad",), ("bad",), ("",), ("worse",)], "word string")
    comments = spark.createDataFrame(
        [(1, "n", 1, "d", "ok,bad"), (2, "n", 2, "d", "bad,ok"), (3, "n", 3, "d", "bad,,"), (4, "n", 4, "d", ","),
         (5, "n", 5, "d", None)], "user_id long, info_consignee string, ts_ms long, ds string, commentTxt string")
    got = {r.user_id: (r.is_violation, r.violation_grade, r.violation_msg)
           for r in quality.flag_sensitive(comments, words).collect()}
    assert got == {1: (1, "P0", "bad"), 2: (0, "", ""), 3: (1, "P0", "bad"), 4: (0, "", ""), 5: (0, "", "")}


def test_route_dims_follows_config(spark):
    change = "op string, before string, after string, ts_ms long"
    conf = lambda src, sink: json.dumps({
        "source_table": src, "sink_table": sink, "sink_row_key": "id", "sink_columns": "id,name"})
    changes = spark.createDataFrame(
        [("r", None, conf("a", "dim_a"), 1), ("c", None, conf("b", "dim_b"), 1), ("d", conf("b", "dim_b"), None, 2),
         ("u", conf("a", "dim_a"), conf("a", "dim_a2"), 3)], change)
    config = current_config(changes)
    assert [(r.source_table, r.sink_table) for r in config.collect()] == [("a", "dim_a2")]
    cdc = spark.createDataFrame(
        [("c", None, '{"id":1,"name":null,"x":2.5}', {"table": "a"}, 1), ("d", '{"id":1}', None, {"table": "a"}, 2),
         ("c", None, '{"id":9}', {"table": "b"}, 1)],
        "op string, before string, after string, source map<string,string>, ts_ms long")
    [row] = route_dims(cdc, config).collect()
    assert (row.sink_table, row.rowkey) == ("dim_a2", "c4ca4238a0b923820dcc509a6f75849b")
    assert row.info == {"id": "1", "name": "null", "x": "2.5"}
    assert set(route_dims(cdc, config, project=True).first().info) == {"id", "name"}


def test_route_dims_leaves_out_tables_without_config(spark, rows, monkeypatch):
    """The parts of a feed that no config names are not computed; with very many tables the join decides alone."""
    feed = derive.cdc_feed(spark, SF_DIR, "sku_info", "order_detail", "order_info")
    config = current_config(derive.config_changes(spark))
    few = route_dims(feed, config)
    read = lambda df: {f.rsplit("/", 1)[-1] for f in df.inputFiles()}
    assert read(few) == {"part.parquet"}
    monkeypatch.setattr(routing, "NAMED_TABLES", 1)
    many = route_dims(feed, config)
    assert "lineitem.parquet" in read(many)
    assert rows(few) == rows(many) and few.count() == 2 * spark.read.parquet(f"{SF_DIR}/part.parquet").count()
    assert route_dims(feed, config.filter("false")).count() == 0


def test_log_keys_of_odd_records(spark, rows):
    raw = spark.createDataFrame([('{"ts":"77"}',), ('{"common":5,"ts":1}',), ("{bad",)], "value string")
    assert rows(log_keys(with_fields(raw)).select("mid", "is_new", "ts")) == sorted(
        [(None, None, 77), (None, None, 1), (None, None, None)], key=repr)


def test_records_are_parsed_once(spark):
    raw = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    used = log_keys(with_fields(raw)).filter("mid IS NOT NULL AND ts > 0").select(
        "mid", F.col("ts") + 1, F.concat("mid", "is_new"))
    assert used._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
