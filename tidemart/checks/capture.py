"""Queries of the change-capture family: routing, state, wide facts, dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.checks.registry import check, sql_time
from tidemart.inputs import derive
from tidemart.inputs.sql import query
from tidemart.operators import joins
from tidemart.operators.latest import latest_n
from tidemart.operators.projections import cdc_after, filter_status, with_event_time
from tidemart.operators.routing import cdc_route, clean_cdc, current_config, route_dims
from tidemart.plans import dim, dwd, dws
from tidemart.schemas import CDC_TABLES, ORDER_CANCELLED
from tidemart.session import shared_dir
from tidemart.sinks.dims import DimStore
from tidemart.sources.tables import load
from tidemart.streaming.watermarks import json_watermark


WIDE_TABLES = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")


def _feed(spark: SparkSession, sf: str, *tables: str) -> DataFrame:
    return derive.cdc_feed(spark, sf, *tables)


def _versioned(spark: SparkSession, sf: str, *tables: str) -> DataFrame:
    """The feed with several versions of rows, deletes and changes of one millisecond."""
    return derive.cdc_feed(spark, sf, *tables, versions=True)


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """The wide fact straight from typed rows, without the JSON envelope."""
    lineitem, orders = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    return joins.order_detail_wide(
        derive.order_detail(lineitem), derive.order_info(orders, load(spark, sf, "customer")),
        derive.order_activity(lineitem), derive.order_coupon(lineitem),
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return derive.order_info(load(spark, sf, "orders"), load(spark, sf, "customer"))


# -- routing and images ----------------------------------------------------------

@check("p1_cdc_route", query("""
    SELECT 'order_info' AS source_table, 'c' AS op, count(*) AS n FROM order_info
    UNION ALL SELECT 'order_info', 'u', count(*) FROM order_info
    UNION ALL SELECT 'order_detail', 'c', count(*) FROM order_detail
    UNION ALL SELECT 'order_detail_activity', 'c', count(*) FROM order_activity
    UNION ALL SELECT 'order_detail_coupon', 'c', count(*) FROM order_coupon
    UNION ALL SELECT 'payment_info', 'c', count(*) FROM payment_info
    UNION ALL SELECT 'order_refund_info', 'c', count(*) FROM refund_info
    UNION ALL SELECT 'refund_payment', 'c', count(*) FROM refund_payment
    UNION ALL SELECT 'cart_info', 'c', count(*) FROM cart_info
    UNION ALL SELECT 'cart_info', 'u', count(*) FROM cart_info WHERE is_ordered = '1'
    UNION ALL SELECT 'cart_info', 'd', count(*) FROM cart_info WHERE is_ordered = '0' AND sku_num < 20
    UNION ALL SELECT 'comment_info', 'c', count(*) FROM comment_info
    UNION ALL SELECT 'sku_info', 'r', count(*) FROM sku_info
    UNION ALL SELECT 'sku_info', 'u', count(*) FROM sku_info"""))
def p1_cdc_route(spark, sf):
    feed = _feed(spark, sf)
    tables = [t for t in CDC_TABLES if t != "table_process_dim"]
    counts = None
    for table in tables:
        n = cdc_route(feed, table).groupBy("op").agg(F.count(F.lit(1)).alias("n"))
        n = n.select(F.lit(table).alias("source_table"), "op", "n")
        counts = n if counts is None else counts.unionByName(n)
    return counts


@check("p2_cdc_after", query("""
    SELECT id, order_id, sku_id, sku_name, order_price, sku_num, create_time, split_activity_amount,
      split_coupon_amount, split_total_amount FROM order_detail"""))
def p2_cdc_after(spark, sf):
    return cdc_after(cdc_route(_feed(spark, sf, "order_detail"), "order_detail"), CDC_TABLES["order_detail"])


@check("p3_event_time", f"""
    SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, {sql_time("date_trunc('second', ts)")} AS event_time FROM events""")
def p3_event_time(spark, sf):
    events = load(spark, sf, "events").select("event_id", F.unix_millis("ts").alias("ts_ms"))
    return with_event_time(events, "ts_ms")


@check("p11_clean_cdc", query("""
    SELECT 'c' AS op, false AS has_before, true AS has_after, count(*) AS n FROM cart_info
    UNION ALL SELECT 'u', false, true, count(*) FROM cart_info WHERE is_ordered = '1'
    UNION ALL SELECT 'd', true, false, count(*) FROM cart_info WHERE is_ordered = '0' AND sku_num < 20"""))
def p11_clean_cdc(spark, sf):
    cleaned = clean_cdc(cdc_route(_feed(spark, sf, "cart_info"), "cart_info"))
    return cleaned.groupBy(
        "op", F.col("before").isNotNull().alias("has_before"), F.col("after").isNotNull().alias("has_after")
    ).agg(F.count(F.lit(1)).alias("n"))


# -- state and facts ---------------------------------------------------------------

@check("dwd_cart_info", query("""
    SELECT is_ordered, cart_price, sku_num, create_time, user_id, sku_id, sku_name, id, operate_time
    FROM cart_now"""))
def cart_info(spark, sf):
    return dwd.cart_info(_feed(spark, sf, "cart_info"))


@check("dwd_comment_info", query("""
    SELECT c.id, c.user_id, c.sku_id, c.appraise, d.dic_name AS appraise_name, c.comment_txt
    FROM comment_info c JOIN dic d ON c.appraise = d.dic_code"""))
def comment_info(spark, sf):
    return dwd.comment_info(_versioned(spark, sf, "comment_info"), derive.base_dic(spark))


WIDE = query("SELECT * FROM wide")


@check("j3_order_detail_wide", WIDE)
def j3_order_detail_wide(spark, sf):
    return _wide(spark, sf)


@check("dwd_order_detail", WIDE)
def order_detail(spark, sf):
    return dwd.order_detail(_versioned(spark, sf, *WIDE_TABLES))


CANCEL = query("""
    SELECT od.id, od.order_id, od.user_id, od.sku_id, od.sku_name, od.province_id, od.activity_id,
      od.activity_rule_id, od.coupon_id, od.date_id, oc.operate_time AS cancel_time, od.sku_num,
      od.split_activity_amount, od.split_coupon_amount, od.split_total_amount, od.ts
    FROM wide od JOIN order_info oc ON od.order_id = oc.id WHERE oc.order_status = 1003""")


@check("j1_order_cancel", CANCEL)
def j1_order_cancel(spark, sf):
    """Cancelled orders are picked first: only their lines are widened."""
    lineitem = load(spark, sf, "lineitem")
    return joins.cancelled_lines(
        derive.order_detail(lineitem), _orders(spark, sf), derive.order_activity(lineitem), derive.order_coupon(lineitem))


@check("dwd_order_cancel", CANCEL)
def order_cancel(spark, sf):
    return dwd.order_cancel(_versioned(spark, sf, *WIDE_TABLES))


_DATE_ID = "cast(epoch(date_trunc('day', epoch_ms({}))) as bigint)"

REFUND = query(f"""
    SELECT ri.id, ri.user_id, ri.order_id, ri.sku_id, oi.province_id, {_DATE_ID.format('ri.create_time')} AS date_id,
      ri.create_time, ri.refund_type, d.dic_name, ri.refund_reason_type, ri.refund_reason_txt, ri.refund_num,
      ri.refund_amount, {sql_time('epoch_ms(ri.create_time)')} AS ts
    FROM refund_info ri JOIN order_info oi ON ri.order_id = oi.id AND oi.order_status = 1005
      JOIN dic d ON cast(oi.order_status as varchar) = d.dic_code""")


@check("j6_order_refund", REFUND)
def j6_order_refund(spark, sf):
    return joins.order_refund(
        derive.refund_info(load(spark, sf, "lineitem")), _orders(spark, sf), derive.base_dic(spark)
    )


@check("dwd_order_refund", REFUND)
def order_refund(spark, sf):
    return dwd.order_refund(_versioned(spark, sf, "order_refund_info", "order_info"), derive.base_dic(spark))


PAID = query(f"""
    SELECT od.id AS order_detail_id, od.order_id, od.user_id, od.sku_id, od.sku_name, od.province_id, od.activity_id,
      od.activity_rule_id, od.coupon_id, p.payment_type AS payment_type_code, d.dic_name AS payment_type_name,
      p.callback_time, od.sku_num, od.split_activity_amount, od.split_coupon_amount,
      od.split_total_amount AS split_payment_amount, {sql_time('epoch_ms(p.create_time)')} AS ts
    FROM payment_info p JOIN wide od ON p.order_id = od.order_id
      AND epoch_ms(od.ts) >= epoch_ms(p.create_time) - INTERVAL 30 DAY
      AND epoch_ms(od.ts) <= epoch_ms(p.create_time) + INTERVAL 30 SECOND
      JOIN dic d ON p.payment_type = d.dic_code
    WHERE p.payment_status = '1602'""")


@check("j5_payment_success", PAID)
def j5_payment_success(spark, sf):
    """Lines meet their payments first: only paid ones are widened."""
    lineitem = load(spark, sf, "lineitem")
    lines = joins.paid_lines(derive.payment_info(load(spark, sf, "orders")), derive.order_detail(lineitem))
    wide = joins.order_detail_wide(
        lines, _orders(spark, sf), derive.order_activity(lineitem), derive.order_coupon(lineitem), keep=joins.PAID)
    return joins.paid_columns(wide, derive.base_dic(spark))


@check("dwd_payment_success", PAID)
def payment_success(spark, sf):
    return dwd.payment_success(_versioned(spark, sf, "payment_info", *WIDE_TABLES), derive.base_dic(spark))


_REFUND_PAY = f"""
    SELECT rp.id, oi.user_id, rp.order_id, rp.sku_id, oi.province_id, rp.payment_type,
      d.dic_name AS payment_type_name, {_DATE_ID.format('rp.callback_time')} AS date_id, rp.callback_time,
      {{num}} AS refund_num, rp.total_amount, {sql_time('epoch_ms(rp.create_time)')} AS ts
    FROM refund_payment rp
      JOIN refund_info ri ON rp.order_id = ri.order_id AND rp.sku_id = ri.sku_id AND ri.refund_status = '0705'
      JOIN order_info oi ON rp.order_id = oi.id AND oi.order_status = 1006
      JOIN dic d ON rp.payment_type = d.dic_code
    WHERE rp.refund_status = '1602'"""


@check("j4_refund_pay", query(_REFUND_PAY.format(num="ri.refund_num")))
def j4_refund_pay(spark, sf):
    lineitem = load(spark, sf, "lineitem")
    return joins.refund_pay(
        derive.refund_payment(lineitem), derive.refund_info(lineitem), _orders(spark, sf), derive.base_dic(spark)
    )


@check("dwd_refund_pay", query(_REFUND_PAY.format(num="max(ri.refund_num)") + " GROUP BY ALL"))
def refund_pay(spark, sf):
    return dwd.refund_pay(_versioned(spark, sf, "refund_payment", "order_refund_info", "order_info"), derive.base_dic(spark))


# -- enrichment ----------------------------------------------------------------------

_LINE = "od.id, od.order_id, od.user_id, od.sku_id, {name} AS sku_name, od.province_id, p.dic_name AS province_name, " \
        "od.activity_id, od.activity_rule_id, od.coupon_id, od.date_id, od.create_time, od.sku_num"


@check("dws_order_province", query(f"""
    SELECT {_LINE.format(name='od.sku_name')},
      cast(cast(od.split_activity_amount as decimal(16,2)) as double) AS split_activity_amount,
      cast(cast(od.split_coupon_amount as decimal(16,2)) as double) AS split_coupon_amount,
      cast(cast(od.split_total_amount as decimal(16,2)) as double) AS split_total_amount, od.ts,
      {sql_time('epoch_ms(od.ts)')} AS event_time
    FROM wide od LEFT JOIN province p ON od.province_id = p.dic_code"""))
def order_province(spark, sf):
    return dws.order_province(_wide(spark, sf), derive.base_province(load(spark, sf, "nation")))


TRADEMARK = f"""
    SELECT {_LINE.format(name='s.sku_name')}, od.split_activity_amount, od.split_coupon_amount,
      od.split_total_amount, od.ts, {sql_time('epoch_ms(od.ts)')} AS event_time, s.tm_id,
      coalesce(t.dic_name, '{joins.UNKNOWN_BRAND}') AS tm_name
    FROM wide od LEFT JOIN province p ON od.province_id = p.dic_code
      LEFT JOIN sku_info s ON od.sku_id = s.id
      LEFT JOIN trademark t ON cast(s.tm_id as varchar) = t.dic_code"""


def _trademark(spark, sf):
    return dws.order_sku_trademark(
        _feed(spark, sf, "sku_info"), _wide(spark, sf), derive.base_province(load(spark, sf, "nation")),
        derive.base_trademark(load(spark, sf, "part")),
    )


@check("dws_order_sku_trademark", query(TRADEMARK))
def order_sku_trademark(spark, sf):
    return _trademark(spark, sf)


@check("o1_latest_lines", query(f"SELECT * FROM ({TRADEMARK}) ORDER BY create_time DESC, id LIMIT 10"))
def o1_latest_lines(spark, sf):
    return latest_n(_trademark(spark, sf), "create_time", 10, ["id"])


@check("j9_prefixed_merge", query("""
    SELECT c.id, c.user_id, c.create_time, o.id AS info_id, o.user_id AS info_user_id,
      o.create_time AS info_create_time, o.consignee AS info_consignee
    FROM payment_info c JOIN order_info o ON c.user_id = o.user_id
      AND epoch_ms(o.create_time) BETWEEN epoch_ms(c.create_time) - INTERVAL 10 DAY
                                      AND epoch_ms(c.create_time) + INTERVAL 5 DAY"""))
def j9_prefixed_merge(spark, sf):
    pay = with_event_time(
        derive.payment_info(load(spark, sf, "orders")).select("id", "user_id", "create_time"), "create_time")
    info = with_event_time(
        _orders(spark, sf).select("id", "user_id", "create_time", "consignee"), "create_time")
    merged = joins.prefixed_merge(
        pay, info, "user_id", "user_id", "event_time", "event_time", -10 * 86_400, 5 * 86_400)
    return merged.drop("event_time", "info_event_time")


@check("j10_hashed_lookup", query("""
    SELECT c.id, c.appraise, coalesce(d.dic_name, 'N/A') AS dic_name
    FROM comment_info c LEFT JOIN dic d ON c.appraise = d.dic_code"""))
def j10_hashed_lookup(spark, sf):
    comments = derive.comment_info(load(spark, sf, "conversations")).select("id", "appraise")
    return joins.hashed_lookup(comments, derive.hashed_dic(spark), "appraise")


# -- config-routed dimensions ----------------------------------------------------------

@check("j11_route_dims", query("""
    SELECT 'dim_sku_info' AS sink_table, md5(cast(id as varchar)) AS rowkey, cast(id as varchar) AS id,
      'draft' AS sku_name, cast(tm_id as varchar) AS tm_id, cast(NULL as varchar) AS sku_num,
      cast(10 as integer) AS fields FROM sku_info
    UNION ALL SELECT 'dim_sku_info', md5(cast(id as varchar)), cast(id as varchar), sku_name,
      cast(tm_id as varchar), NULL, 10 FROM sku_info
    UNION ALL SELECT 'dim_cart', md5(id), id, sku_name, NULL, cast(sku_num as varchar), 9 FROM cart_info
    UNION ALL SELECT 'dim_cart', md5(id), id, sku_name, NULL, cast(sku_num as varchar), 9 FROM cart_info
      WHERE is_ordered = '1'"""))
def j11_route_dims(spark, sf):
    """Rows routed by the config in force; a null field is not part of the JSON image."""
    config = current_config(derive.config_changes(spark))
    rows = route_dims(_feed(spark, sf), config)
    field = lambda name: F.try_element_at("info", F.lit(name)).alias(name)
    return rows.select(
        "sink_table", "rowkey", field("id"), field("sku_name"), field("tm_id"), field("sku_num"),
        F.size("info").alias("fields"),
    )


@check("p17_route_dims_projected", query("""
    SELECT 'dim_sku_info' AS sink_table, md5(cast(id as varchar)) AS rowkey, 'id,sku_name,tm_id' AS columns
    FROM sku_info
    UNION ALL SELECT 'dim_sku_info', md5(cast(id as varchar)), 'id,sku_name,tm_id' FROM sku_info
    UNION ALL SELECT 'dim_cart', md5(id), 'id,sku_id,sku_num' FROM cart_info
    UNION ALL SELECT 'dim_cart', md5(id), 'id,sku_id,sku_num' FROM cart_info WHERE is_ordered = '1'"""))
def p17_route_dims_projected(spark, sf):
    rows = route_dims(_feed(spark, sf), current_config(derive.config_changes(spark)), project=True)
    names = F.array_join(F.array_sort(F.map_keys("info")), ",")
    return rows.select("sink_table", "rowkey", names.alias("columns"))


@check("s16_dim_reads", """
    SELECT 'scan' AS what, least(count(*), 10) AS n FROM part
    UNION ALL SELECT 'count', count(*) FROM part
    UNION ALL SELECT 'get', count(*) FROM part WHERE p_partkey = 7
    UNION ALL SELECT 'deleted', count(*) FROM part WHERE p_type <> 'ECONOMY'""")
def s16_dim_reads(spark, sf):
    """A dimension written, scanned, counted, read by key and thinned by keys."""
    folder = shared_dir(spark, "dim-reads")
    store = DimStore(spark, folder, f"dims_{folder[-12:]}")
    rows = dim.dim_goods(derive.goods_log(load(spark, sf, "part"))).select(
        "rowkey", F.from_json(F.to_json("info"), "map<string,string>").alias("info"))
    store.create("dim_goods")
    store.write("dim_goods", rows, 0)

    def counted(what: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")

    store.create("dim_left")
    store.write("dim_left", store.read("dim_goods"), 0)
    store.delete("dim_left", rows.filter("info['operate_type'] = 'ECONOMY'"), 1)
    parts = [
        counted("scan", store.scan("dim_goods", 10)), counted("count", store.read("dim_goods")),
        counted("get", store.get("dim_goods", "7")), counted("deleted", store.read("dim_left")),
    ]
    return reduce(DataFrame.unionByName, parts)


@check("p4_filter_status", query("SELECT id, order_status FROM order_info WHERE order_status = 1003"))
def p4_filter_status(spark, sf):
    return filter_status(_orders(spark, sf), "order_status", ORDER_CANCELLED).select("id", "order_status")


@check("w2_comment_time", query(f"""
    SELECT id, {sql_time('epoch_ms(create_time)')} AS event_time FROM comment_info"""))
def w2_comment_time(spark, sf):
    """Event time out of the JSON text of whole change records."""
    feed = _feed(spark, sf, "comment_info")
    records = feed.select(
        F.get_json_object("after", "$.id").alias("id"), F.to_json(F.struct("op", "after", "ts_ms")).alias("value"))
    return json_watermark(records, "ts_ms").select("id", "event_time")
