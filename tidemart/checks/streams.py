"""Streaming forms over the given tables; each result equals its batch form.

The tables are read as streams of files, all there is is handled, and the final
state is returned. Working folders lie below the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemart.checks.capture  # noqa: F401  (registers the SQL reused here)
import tidemart.checks.quality  # noqa: F401
import tidemart.checks.relational  # noqa: F401
from tidemart.checks.quality import BLOOM_RATE, bloom_quality
from tidemart.checks.registry import SQL, check, sql_time
from tidemart.inputs import derive
from tidemart.inputs.sql import query
from tidemart.operators import joins
from tidemart.operators.aggregates import page_visitors, visitor_counts
from tidemart.operators.projections import cdc_image, with_event_time
from tidemart.operators.routing import cdc_route, log_keys, with_fields
from tidemart.plans.dwd import user_behavior_fact
from tidemart.schemas import CDC_TABLES
from tidemart.session import remove_folder, shared_dir, stream_session
from tidemart.sinks.days import DayFiles, write_day_partitioned
from tidemart.sinks.dims import DimStore
from tidemart.sinks.topics import open_writers, write_batch_json
from tidemart.sinks.upsert import UpsertTable
from tidemart.sources.cdc import read_cdc
from tidemart.sources.tables import load, load_stream
from tidemart.sources.topics import TopicSpec
from tidemart.checks.relational import DASHBOARD_DAY
from tidemart.streaming import facts, jobs, retention, stateful
from tidemart.streaming.dims import DimsJob
from tidemart.streaming.payments import FEED, PaymentJob
from tidemart.streaming.watermarks import watermark


def _appended(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows a stream appends, as files."""
    folder = shared_dir(spark, name)
    jobs.finish(
        df.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
        .format("parquet").option("path", f"{folder}/rows")
    )
    return spark.read.parquet(f"{folder}/rows")


@check("t8_stream_user_visit", SQL["dws_user_visit_agg"])
def t8_stream_user_visit(spark, sf):
    child = stream_session(spark)
    folder = shared_dir(spark, "user-visit")
    table = UpsertTable(f"{folder}/table", ["user_id", "dt"])
    log = derive.behavior_log(load_stream(child, sf, "events"))
    jobs.finish(jobs.user_visit_stream(log, table, f"{folder}/checkpoint"))
    return table.read(child)


@check("s7_stream_cart", SQL["dwd_cart_info"])
def s7_stream_cart(spark, sf):
    """Change records through a topic (S6, S3) into a keyed table with deletes."""
    child = stream_session(spark)
    folder = shared_dir(spark, "cart")
    topic = TopicSpec("cart_changes", folder=f"{folder}/topic")
    write_batch_json(cdc_route(derive.cdc_feed(child, sf, "cart_info"), "cart_info"), topic)
    changes = cdc_image(cdc_route(read_cdc(child, topic), "cart_info"), CDC_TABLES["cart_info"])
    table = UpsertTable(f"{folder}/table", ["id"], ["ts_ms"])
    jobs.finish(jobs.upsert_stream(changes, table, f"{folder}/checkpoint"))
    return table.read(child).drop("ts_ms")


@check("j5_stream_payment_success", query(f"""
    SELECT p.order_id, od.id AS order_detail_id, {sql_time('epoch_ms(p.create_time)')} AS pay_ts
    FROM payment_info p JOIN order_detail od ON p.order_id = od.order_id
      AND epoch_ms(od.create_time) >= epoch_ms(p.create_time) - INTERVAL 30 DAY
      AND epoch_ms(od.create_time) <= epoch_ms(p.create_time) + INTERVAL 30 SECOND"""))
def j5_stream_payment_success(spark, sf):
    """Two watermarked streams joined on key and time range."""
    child = stream_session(spark)
    # Inner rows come with data: a batch without any would go through all state only to let it expire, as the next one does.
    child.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    pay = with_event_time(derive.payment_info(load_stream(child, sf, "orders")), "create_time", "pay_ts")
    detail = with_event_time(derive.order_detail(load_stream(child, sf, "lineitem")), "create_time", "event_time")
    left = watermark(pay.select(F.col("order_id").alias("_order"), "pay_ts"), "pay_ts")
    right = watermark(detail.select(F.col("id").alias("order_detail_id"), "order_id", "event_time"), "event_time")
    matched = left.join(
        right,
        (F.col("_order") == F.col("order_id")) & joins.within("pay_ts", "event_time", "-30 days", "30 seconds"),
    )
    return _appended(child, matched.select("order_id", "order_detail_id", "pay_ts"), "payment-success")


@check("j6_stream_lookup", query("""
    SELECT c.id, c.user_id, c.sku_id, c.appraise, d.dic_name || CASE WHEN cast(c.user_id as bigint) % 2 = 1 THEN ' (new)' ELSE '' END
      AS appraise_name, c.comment_txt
    FROM comment_info c JOIN dic d ON c.appraise = d.dic_code"""))
def j6_stream_lookup(spark, sf):
    """Comments named from a stored dimension that is replaced between two micro-batches."""
    child = stream_session(spark)
    folder = shared_dir(spark, "comment-lookup")
    store, table = DimStore(child, f"{folder}/store", f"lookup_{folder[-12:]}"), "dim_base_dic"
    store.create(table)
    comments, names = derive.comment_info(load(child, sf, "conversations")), derive.base_dic(child)
    topic = TopicSpec("comments", folder=f"{folder}/topic")

    def lookup(batch: DataFrame) -> DataFrame:
        info = F.col("info")
        dim = store.read(table).select(
            info["dic_code"].alias("dic_code"), F.struct(info["dic_name"].alias("dic_name")).alias("info"))
        return joins.comment_named(batch, dim)

    for version, suffix in enumerate(("", " (new)")):
        row = F.create_map(
            F.lit("dic_code"), F.col("dic_code"), F.lit("dic_name"), F.concat(F.col("info.dic_name"), F.lit(suffix)))
        store.write(table, names.select(F.md5("dic_code").alias("rowkey"), row.alias("info")), version)
        part = comments.filter(F.col("user_id").cast("bigint") % 2 == version)
        part.write.mode("append").json(topic.folder)
        stream = child.readStream.schema(comments.schema).json(topic.folder)
        jobs.finish(jobs.lookup_stream(stream, lookup, f"{folder}/rows", f"{folder}/checkpoint"))
    out = child.read.parquet(f"{folder}/rows").drop("batch")
    store.drop_all()
    return out


@check("t1_stream_fix_is_new", query("SELECT log_id, mid, ms AS ts, is_new FROM fixed_log"))
def t1_stream_fix_is_new(spark, sf):
    child = stream_session(spark)
    keyed = log_keys(with_fields(derive.app_log(load_stream(child, sf, "events"))))
    rows = keyed.select("log_id", "mid", "is_new", "ts")
    folder = shared_dir(spark, "fix-is-new")
    visits = stateful.FirstVisits(f"{folder}/visits")

    def step(batch: DataFrame, batch_id: int) -> None:
        visits.repair(batch, batch_id, "log_id").write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    jobs.finish(jobs.batch_job(rows, f"{folder}/checkpoint", step))
    return child.read.parquet(f"{folder}/rows").drop("batch").filter("mid IS NOT NULL")


@check("t2_stream_dedup_latest", SQL["t2_dedup_latest"])
def t2_stream_dedup_latest(spark, sf):
    """Micro-batches in the order of arrival; the second is run twice, as after a failure."""
    child = stream_session(spark)
    folder = shared_dir(spark, "dedup-latest")
    rows = load(child, sf, "events").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    last = rows.agg(F.max("event_id")).first()[0] or 0
    times = stateful.LatestTimes(f"{folder}/times", "user_id", "k")

    def step(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id == 1 else 1):
            times.keep(batch, batch_id, "event_id").write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    for part in range(3):
        rows.filter(F.floor(F.col("event_id") * 3 / (last + 1)) == part).write.mode("append").parquet(f"{folder}/feed")
        feed = child.readStream.schema(rows.schema).parquet(f"{folder}/feed")
        jobs.finish(jobs.batch_job(feed, f"{folder}/checkpoint", step))
    return child.read.parquet(f"{folder}/rows").drop("batch")


@check("t3_stream_dedup_exact", SQL["t3_dedup_exact"])
def t3_stream_dedup_exact(spark, sf):
    child = stream_session(spark)
    folder = shared_dir(spark, "dedup-exact")
    rows = load_stream(child, sf, "events").select(
        "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    step = stateful.dedup_exact_batches(folder, rows.columns)
    jobs.finish(jobs.batch_job(rows, f"{folder}/checkpoint", step))
    return stateful.dedup_exact_rows(child, folder)


@check("t4_stream_dedup_bloom", SQL["t4_dedup_bloom"])
def t4_stream_dedup_bloom(spark, sf):
    """As in the batch form: filters designed for far fewer keys than come."""
    child = stream_session(spark)
    rows = load_stream(child, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.unix_millis("l_shipdate").alias("ts_ms"))
    shards = child.sparkContext.defaultParallelism
    kept = _appended(child, stateful.dedup_bloom_stream(rows, expected=1000, rate=BLOOM_RATE, shards=shards), "dedup-bloom")
    batch = load(child, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.unix_millis("l_shipdate").alias("ts_ms"))
    return bloom_quality(kept, batch)


@check("t7_stream_log_split", SQL["log_split"])
def t7_stream_log_split(spark, sf):
    child = stream_session(spark)
    folder = shared_dir(spark, "log-split")
    raw = derive.app_log(load_stream(child, sf, "events"))
    jobs.finish(jobs.log_split_stream(
        raw, "log_id", f"{folder}/rows", f"{folder}/checkpoint", stateful.FirstVisits(f"{folder}/visits")))
    return child.read.parquet(f"{folder}/rows").select("output", "log_id", "value")


@check("t9_stream_page_uv", SQL["t9_page_uv"])
def t9_stream_page_uv(spark, sf):
    """All windows: visitors are kept in a keyed table as they come, and counted from it."""
    child = stream_session(spark)
    folder = shared_dir(spark, "page-uv")
    keyed = log_keys(with_fields(derive.app_log(load_stream(child, sf, "events"))))
    log = keyed.select(
        "mid", F.expr("try_variant_get(fields['page'], '$.page_id', 'string')").alias("page_id"),
        F.timestamp_millis("ts").alias("ts"),
    )
    table = UpsertTable(f"{folder}/visitors", ["window", "mid"])
    jobs.finish(jobs.upsert_stream(page_visitors(watermark(log, "ts"), "1 hour"), table, f"{folder}/checkpoint", "update"))
    return visitor_counts(table.read(child))


def _day_records(events: DataFrame) -> DataFrame:
    """JSON records with seconds, milliseconds and unreadable times."""
    ms = F.unix_millis("ts")
    kind = F.col("event_type")
    at = F.when(kind == "view", F.call_function("div", ms, F.lit(1000))).otherwise(ms).cast("string")
    return events.select(
        F.to_json(F.struct(F.col("event_id"), F.when(kind == "error", "none").otherwise(at).alias("at"))).alias("value"))


@check("s11_day_partitions", """
    SELECT CASE WHEN event_type = 'error' THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day,
      count(*) AS n FROM events GROUP BY 1""")
def s11_day_partitions(spark, sf):
    """Seconds, milliseconds and unreadable times into day folders."""
    path = shared_dir(spark, "days")
    write_day_partitioned(_day_records(load(spark, sf, "events")), "at", path)
    return spark.read.text(path).groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


@check("s11_stream_days", """
    SELECT CASE WHEN event_type = 'error' THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day, event_id
    FROM events""")
def s11_stream_days(spark, sf):
    """Day files of a stream of five micro-batches: one is run again, and days are merged in between."""
    child = stream_session(spark)
    folder = shared_dir(spark, "day-files")
    _day_records(load(child, sf, "events")).repartition(5).write.text(f"{folder}/feed")
    files = DayFiles(f"{folder}/days", "at", idle=0)
    write = files.batch_writer()

    def step(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 3:
            write(batch, batch_id)

    feed = child.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{folder}/feed")
    jobs.finish(jobs.batch_job(feed, f"{folder}/checkpoint", step))
    return files.read(child).select("day", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))


@check("s9_stream_dims", query("""
    SELECT 'dim_sku_info' AS sink_table, md5(cast(id as varchar)) AS rowkey, cast(id as varchar) AS id, sku_name
    FROM sku_info
    UNION ALL SELECT 'dim_cart', md5(id), id, sku_name FROM cart_info"""))
def s9_stream_dims(spark, sf):
    """Configured tables of a change stream into dimension tables."""
    child = stream_session(spark)
    folder = shared_dir(spark, "dims")
    topic = TopicSpec("changes", folder=f"{folder}/topic")
    write_batch_json(derive.cdc_feed(child, sf, "sku_info", "cart_info", "comment_info"), topic)
    store = DimStore(child, f"{folder}/store", f"dims_{folder[-12:]}")
    jobs.finish(jobs.dims_stream(
        read_cdc(child, topic), lambda: derive.config_changes(child), store, f"{folder}/checkpoint"))
    rows = None
    for name in ("dim_sku_info", "dim_cart"):
        one = store.read(name).select(
            F.lit(name).alias("sink_table"), "rowkey", F.try_element_at("info", F.lit("id")).alias("id"),
            F.try_element_at("info", F.lit("sku_name")).alias("sku_name"))
        rows = one if rows is None else rows.unionByName(one)
    kept = f"{folder}/out"
    rows.write.parquet(kept)
    store.drop_all()
    return child.read.parquet(kept)


@check("cdc_to_dims_stream", f"""
    WITH carts AS (SELECT event_id, epoch_ms(ts) AS t FROM events
      UNION ALL SELECT event_id, epoch_ms(ts) + 1000 FROM events WHERE event_type = 'purchase'),
    routed AS (SELECT 'dim_sku_draft' AS sink_table, md5(cast(p_partkey AS varchar)) AS rowkey, 'draft' AS name FROM part
      UNION ALL SELECT 'dim_sku', md5(cast(p_partkey AS varchar)), p_name FROM part
      UNION ALL SELECT CASE WHEN t < {derive.CART_STOP_MS} THEN 'dim_cart' ELSE 'dim_cart_late' END, md5(cast(event_id AS varchar)), 'cart'
      FROM carts WHERE t < {derive.CART_STOP_MS} OR t >= {derive.CART_AGAIN_MS})
    SELECT sink_table, rowkey, count(*) AS n_records, max(name) AS name, sink_table IN ('dim_sku', 'dim_cart_late') AS in_table
    FROM routed GROUP BY sink_table, rowkey
    UNION ALL SELECT 'dirty', NULL, 2, NULL, false""")
def cdc_to_dims_stream(spark, sf):
    """Routing config that changes and ends in mid-stream; records before a change keep the old sink."""
    child = stream_session(spark)
    folder = shared_dir(spark, "cdc-dims")
    topic = TopicSpec("changes", folder=f"{folder}/topic")
    store = DimStore(child, f"{folder}/store", f"dims_{folder[-12:]}")
    job = DimsJob(store, f"{folder}/job")
    feed = derive.cdc_feed(child, sf, "sku_info", "cart_info").unionByName(derive.midstream_config(child))
    for low, high in ((0, derive.SKU_MOVE_MS), (derive.SKU_MOVE_MS, derive.CART_STOP_MS + 1), (derive.CART_STOP_MS + 1, 1 << 60)):
        part = feed.filter((F.col("ts_ms") >= low) & (F.col("ts_ms") < high))
        if low == 0:  # two records that cannot be read
            part = part.unionByName(child.range(2).select(
                F.lit(None).cast("string").alias("op"), F.lit("?").alias("before"), F.lit("?").alias("after"),
                F.lit(None).cast("map<string,string>").alias("source"), F.lit(1).cast("bigint").alias("ts_ms")))
        write_batch_json(part, topic)
        jobs.finish(job.stream(read_cdc(child, topic), f"{folder}/checkpoint"))  # a micro-batch for each part
    routed = child.read.parquet(f"{folder}/job/routed")
    name = F.when(F.col("source_table") == "cart_info", "cart").otherwise(F.try_element_at("info", F.lit("sku_name")))
    decided = routed.groupBy("sink_table", "rowkey").agg(F.count(F.lit(1)).alias("n_records"), F.max(name).alias("name"))
    kept = None
    for sink in store.list_dims():
        one = store.read(sink).select(F.lit(sink).alias("sink_table"), "rowkey", F.lit(True).alias("in_table"))
        kept = one if kept is None else kept.unionByName(one)
    rows = decided.join(kept, ["sink_table", "rowkey"], "full_outer").withColumn("in_table", F.coalesce("in_table", F.lit(False)))
    dirty = child.read.parquet(f"{folder}/job/dirty").agg(F.count(F.lit(1)).alias("n_records"))
    dirty = dirty.select(
        F.lit("dirty").alias("sink_table"), F.lit(None).cast("string").alias("rowkey"), "n_records", F.lit(None).cast("string").alias("name"), F.lit(False).alias("in_table"))
    rows.unionByName(dirty).write.parquet(f"{folder}/out")
    store.drop_all()
    return child.read.parquet(f"{folder}/out")


#: Micro-batches of the fact streams; the versions of a row fall into any of them.
PARTS = 3


def _fact_stream(spark: SparkSession, sf: str, name: str, build, *tables: str) -> DataFrame:
    """Changes with versions and deletes, in several files and micro-batches, into a fact."""
    child = stream_session(spark)
    folder = shared_dir(spark, name)
    feed = derive.cdc_feed(child, sf, *tables, versions=True)
    part = F.pmod(F.xxhash64("before", "after", "op"), F.lit(PARTS))
    write_batch_json(feed, TopicSpec("changes", folder=f"{folder}/topic"), part)
    fact = build(f"{folder}/tables")
    for n in range(PARTS):
        topic = TopicSpec("changes", folder=f"{folder}/topic/part={n}")
        jobs.finish(fact.stream(read_cdc(child, topic), f"{folder}/checkpoint/{n}", first=n))
        remove_folder(child, topic.folder)  # a topic lets go what has been handled
    return fact.fact.read(child)


#: Buckets of the payment tables here; a table of many files needs more.
FEW_BUCKETS = 4


def _repeating(job: PaymentJob, parts: list[DataFrame], folder: str, child: SparkSession) -> None:
    """Run a job over a feed whose parts arrive one by one, each a micro-batch; the second is run twice, as after a failure."""

    def step(batch: DataFrame, batch_id: int) -> None:
        job.step(batch, batch_id)
        if batch_id == 1:
            job.step(batch, batch_id)

    for part in parts:
        part.write.mode("append").parquet(f"{folder}/feed")
        feed = child.readStream.schema(FEED).parquet(f"{folder}/feed")
        jobs.finish(jobs.batch_job(feed, f"{folder}/checkpoint", step))


@check("dwd_trade_payment_fact_stream", SQL["dwd_trade_payment_fact"])
def dwd_trade_payment_fact_stream(spark, sf):
    """J2 on a stream: orders come after their payments and correct them."""
    child = stream_session(spark)
    folder = shared_dir(spark, "payment-fact")
    job = PaymentJob(f"{folder}/tables", sums=False, buckets=FEW_BUCKETS)
    _repeating(job, derive.payment_feed(load(child, sf, "events")), folder, child)
    return job.fact.read(child)


@check("a1_stream_payment_agg", SQL["dws_trade_payment_agg"])
def a1_stream_payment_agg(spark, sf):
    """Sums per user and day with retractions."""
    child = stream_session(spark)
    folder = shared_dir(spark, "payment-agg")
    job = PaymentJob(f"{folder}/tables", buckets=FEW_BUCKETS)
    _repeating(job, derive.payment_feed(load(child, sf, "events")), folder, child)
    return job.sums.read(child)


NEXT_DAY = "2024-01-16"


@check("a4_stream_dashboard", query("""
    SELECT dt AS day, metric_key, metric_value FROM (
      SELECT dt, 'today_gmv' AS metric_key, cast(cast(sum(pay_amount) as decimal(20,2)) as varchar) AS metric_value
      FROM payment_fact GROUP BY dt
      UNION ALL SELECT dt, 'today_order_count', cast(count(*) as varchar) FROM payment_fact GROUP BY dt
      UNION ALL SELECT dt, 'today_customer_count', cast(count(DISTINCT user_id) as varchar) FROM payment_fact GROUP BY dt)
    WHERE dt IN ('%s', '%s')""" % (DASHBOARD_DAY, NEXT_DAY)))
def a4_stream_dashboard(spark, sf):
    """Two days: the feed of the first, midnight, the feed of the second; each day as it stood at its end."""
    child = stream_session(spark)
    folder = shared_dir(spark, "dashboard")
    events = load(child, sf, "events")
    days = [(DASHBOARD_DAY, events.filter(F.col("ts") < NEXT_DAY)), (NEXT_DAY, events.filter(F.col("ts") >= NEXT_DAY))]
    rows = []
    for day, part in days:
        job = PaymentJob(f"{folder}/tables", sums=False, today=lambda batch, batch_id, day=day: day, buckets=FEW_BUCKETS)
        _repeating(job, derive.payment_feed(part), folder, child)
        job.dashboard.read(child, day).select(F.lit(day).alias("day"), "*").write.parquet(f"{folder}/out/{day}")
        rows.append(child.read.parquet(f"{folder}/out/{day}"))
    return rows[0].unionByName(rows[1])


@check("t5_stream_order_cancel", SQL["j1_order_cancel"])
def t5_stream_order_cancel(spark, sf):
    """J1 on two streams of several micro-batches with keyed state; without a time to live it loses no row."""
    child = stream_session(spark)
    folder = shared_dir(spark, "retained-cancel")
    orders = derive.order_info(load(child, sf, "orders"), load(child, sf, "customer"))
    lineitem = load(child, sf, "lineitem")
    wide = joins.order_detail_wide(
        derive.order_detail(lineitem), orders, derive.order_activity(lineitem), derive.order_coupon(lineitem))
    streams = []
    for name, rows in (("wide", wide), ("orders", orders)):
        # Every task writes a file of each part, so that nothing is shuffled for the micro-batches.
        with open_writers(child):
            rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS))).write.partitionBy("part").parquet(f"{folder}/{name}", compression="zstd")
        files = len(child.read.parquet(f"{folder}/{name}").inputFiles())
        feed = child.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, -(-files // PARTS)))
        feed = feed.option("cleanSource", "delete").parquet(f"{folder}/{name}")  # files go once they are handled
        streams.append(feed.select(*rows.columns))
    return _appended(child, retention.order_cancel_stream(*streams), "order-cancel-retained")


@check("t5_stream_user_visit", SQL["dws_user_visit_agg"])
def t5_stream_user_visit(spark, sf):
    """A2 with keyed state, over several micro-batches into a keyed table."""
    child = stream_session(spark)
    folder = shared_dir(spark, "retained-visit")
    load(child, sf, "events").repartition(3).write.parquet(f"{folder}/events")
    events = child.readStream.schema(load(child, sf, "events").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    totals = retention.user_visit_totals(user_behavior_fact(derive.behavior_log(events)))
    table = UpsertTable(f"{folder}/table", ["user_id", "dt"])
    jobs.finish(jobs.upsert_stream(totals, table, f"{folder}/checkpoint", "update"))
    return table.read(child)


@check("dwd_order_detail_stream", SQL["dwd_order_detail"])
def dwd_order_detail_stream(spark, sf):
    return _fact_stream(spark, sf, "order-detail", lambda root: facts.order_detail(root, FEW_BUCKETS), *facts.WIDE)


@check("dwd_order_cancel_stream", SQL["dwd_order_cancel"])
def dwd_order_cancel_stream(spark, sf):
    return _fact_stream(spark, sf, "order-cancel", lambda root: facts.order_cancel(root, FEW_BUCKETS), *facts.WIDE)


@check("dwd_order_refund_stream", SQL["dwd_order_refund"])
def dwd_order_refund_stream(spark, sf):
    build = lambda root: facts.order_refund(root, lambda: derive.base_dic(spark), FEW_BUCKETS)
    return _fact_stream(spark, sf, "order-refund", build, "order_refund_info", "order_info")


@check("dwd_refund_pay_stream", SQL["dwd_refund_pay"])
def dwd_refund_pay_stream(spark, sf):
    build = lambda root: facts.refund_pay(root, lambda: derive.base_dic(spark), FEW_BUCKETS)
    return _fact_stream(spark, sf, "refund-pay", build, "refund_payment", "order_refund_info", "order_info")


@check("dwd_payment_success_stream", SQL["dwd_payment_success"])
def dwd_payment_success_stream(spark, sf):
    build = lambda root: facts.payment_success(root, lambda: derive.base_dic(spark), FEW_BUCKETS)
    return _fact_stream(spark, sf, "payment-success", build, "payment_info", *facts.WIDE)
