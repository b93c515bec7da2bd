"""Queries of the relational family: facts, daily summaries, segments, dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.checks.registry import check, sql_time
from tidemart.inputs import derive
from tidemart.inputs.sql import query
from tidemart.operators import aggregates, joins, projections
from tidemart.plans import ads, dim, dwd, dws, ods
from tidemart.sources.tables import load

DASHBOARD_DAY = "2024-01-15"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events")


def _payments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, sf)
    return derive.trade_payment(events), derive.trade_order(events)


def _visit_pay(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    visit = dws.user_visit(derive.behavior_log(_events(spark, sf)))
    return visit, dws.trade_payment(*_payments(spark, sf))


NEW_OLD = """
    SELECT strftime(login_date, '%Y-%m-%d') AS login_date,
      cast(sum(CASE WHEN login_date = first_login THEN 1 ELSE 0 END) as bigint) AS new_users,
      cast(sum(CASE WHEN login_date > first_login THEN 1 ELSE 0 END) as bigint) AS old_users
    FROM (SELECT user_id, cast(ts as date) AS login_date FROM events) l
    JOIN (SELECT user_id, min(cast(ts as date)) AS first_login FROM events GROUP BY user_id) f USING (user_id)
    GROUP BY login_date"""


@check("new_old_users", NEW_OLD)
def new_old_users(spark, sf):
    return aggregates.new_old_users(derive.login_log(_events(spark, sf)))


# -- copies and dimensions -----------------------------------------------------

def _ods(table: str, source: str, build, sql: str) -> None:
    @check(f"ods_copy_{table.removeprefix('ods_')}", query(sql))
    def copy(spark, sf):
        return ods.ods_copy(build(load(spark, sf, source)), table)


def _json(**fields: str) -> str:
    """SQL of a compact JSON object; each value is SQL text of a JSON scalar."""
    parts = [f"'\"{name}\":' || {value}" for name, value in fields.items()]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _q(expr: str) -> str:
    """SQL of a JSON text scalar; null stays an explicit null."""
    return f"""coalesce('"' || {expr} || '"', 'null')"""


def _n(expr: str) -> str:
    return f"coalesce(cast({expr} as varchar), 'null')"


def _time(expr: str) -> str:
    # A timestamp cast to text drops a zero fraction.
    return _q(f"CASE WHEN {expr} = date_trunc('second', {expr}) THEN strftime({expr}, '%Y-%m-%d %H:%M:%S') "
              f"ELSE rtrim(strftime({expr}, '%Y-%m-%d %H:%M:%S.%f'), '0') END")


_ods("ods_user_behavior_log", "events", derive.behavior_log, "SELECT " + _json(
    user_id=_q("user_id"), device_id=_q("device_id"), visit_type=_q("visit_type"), event_time=_time("event_time"),
    page_url=_q("page_url"), page_type=_q("page_type"), is_follow_shop=_n("is_follow_shop"),
    proc_time=_time("proc_time")) + " AS value FROM behavior_log")
_ods("ods_trade_order", "events", derive.trade_order, "SELECT " + _json(
    order_id=_n("order_id"), user_id=_q("user_id"), order_time=_time("order_time"), pay_amount=_n("pay_amount"),
    is_paid=_n("is_paid"), order_status=_q("order_status"), goods_type=_q("goods_type"), goods_id=_q("goods_id"),
    shop_id=_q("shop_id")) + " AS value FROM trade_order")
_ods("ods_trade_payment", "events", derive.trade_payment, "SELECT " + _json(
    pay_id=_q("pay_id"), order_id=_n("order_id"), pay_time=_time("pay_time"), pay_amount=_n("pay_amount"),
    pay_method=_q("pay_method"), pay_status=_q("pay_status"), user_id=_q("user_id"))
    + " AS value FROM trade_payment")
_ods("ods_goods_operation_log", "part", derive.goods_log, "SELECT " + _json(
    id=_n("p_partkey"), goods_id=_q("'g_' || p_partkey"), operate_type=_q("p_type"),
    operate_time=_q("'2024-01-01 00:00:00'"), price=_n("cast(p_retailprice as decimal(10,2))"),
    stock_num=_n("p_size"), operate_content=_q("p_name")) + " AS value FROM part")
_ods("ods_marketing_activity_log", "lineitem", derive.activity_log, "SELECT " + _json(
    id=_n("l_orderkey"), activity_id=_q("l_linenumber"), user_id=_q("l_suppkey"), activity_type=_q("l_returnflag"),
    get_time=_q("strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"),
    use_time=_q("CASE WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END"),
    coupon_amount=_n("cast(l_extendedprice as decimal(10,2))"), coupon_code=_q("l_linestatus"))
    + " AS value FROM lineitem")
_ods("ods_user_register_log", "customer", derive.register_log, "SELECT " + _json(
    user_id=_q("c_custkey"), register_time=_q("'2024-01-01 00:00:00'"), register_channel=_q("c_mktsegment"),
    device_id=_q("'d_' || c_custkey"), register_ip=_q("'10.0.0.' || c_nationkey")) + " AS value FROM customer")
_ods("ods_shop_operation_log", "supplier", derive.shop_log, "SELECT " + _json(
    id=_n("s_suppkey"), shop_id=_q("s_name"),
    operate_type=_q("CASE WHEN s_acctbal >= 0 THEN 'open' ELSE 'close' END"),
    operate_time=_q("'2024-01-01 00:00:00'"), operate_content=_q("'status'"), operator_id=_q("s_nationkey"))
    + " AS value FROM supplier")


@check("dim_goods", """
    SELECT cast(p_partkey as varchar) AS rowkey, 'g_' || p_partkey AS goods_id, p_type AS operate_type,
      '2024-01-01 00:00:00' AS operate_time, cast(cast(p_retailprice as decimal(16,2)) as varchar) AS price,
      cast(p_size as varchar) AS stock_num, p_name AS operate_content FROM part""")
def dim_goods(spark, sf):
    return dim.dim_goods(derive.goods_log(load(spark, sf, "part"))).select("rowkey", "info.*")


@check("dim_shop", """
    SELECT cast(s_suppkey as varchar) AS rowkey, s_name AS shop_id,
      CASE WHEN s_acctbal >= 0 THEN 'open' ELSE 'close' END AS operate_type, '2024-01-01 00:00:00' AS operate_time,
      'status' AS operate_content, cast(s_nationkey as varchar) AS operator_id FROM supplier""")
def dim_shop(spark, sf):
    return dim.dim_shop(derive.shop_log(load(spark, sf, "supplier"))).select("rowkey", "info.*")


@check("dim_user", """
    SELECT cast(c_custkey as varchar) AS rowkey, '2024-01-01 00:00:00' AS register_time,
      c_mktsegment AS register_channel, 'd_' || c_custkey AS device_id, '10.0.0.' || c_nationkey AS register_ip
    FROM customer""")
def dim_user(spark, sf):
    return dim.dim_user(derive.register_log(load(spark, sf, "customer"))).select("rowkey", "info.*")


# -- facts ----------------------------------------------------------------------

@check("dwd_user_behavior_fact", query(f"""
    SELECT user_id, device_id, visit_type, {sql_time('event_time')} AS event_time, page_type, is_follow_shop,
      is_new_visit, is_return_visit, is_purchase_visit, {sql_time('proc_time')} AS proc_time, dt
    FROM behavior_fact"""))
def user_behavior_fact(spark, sf):
    return dwd.user_behavior_fact(derive.behavior_log(_events(spark, sf)))


PAYMENT_FACT = query(f"""
    SELECT pay_id, order_id, user_id, {sql_time('pay_time')} AS pay_time, cast(pay_amount as double) AS pay_amount,
      pay_method, pay_status, goods_type, goods_id, shop_id, dt FROM payment_fact""")


@check("j2_payment_fact", PAYMENT_FACT)
def j2_payment_fact(spark, sf):
    return joins.payment_fact(*_payments(spark, sf))


@check("dwd_trade_payment_fact", PAYMENT_FACT)
def trade_payment_fact(spark, sf):
    return dwd.trade_payment_fact(*_payments(spark, sf))


# -- daily summaries --------------------------------------------------------------

@check("dws_user_visit_agg", query(f"""
    SELECT user_id, dt, visit_count, cast(new_visit_count as bigint) AS new_visit_count,
      cast(return_visit_count as bigint) AS return_visit_count,
      cast(purchase_visit_count as bigint) AS purchase_visit_count,
      cast(follow_shop_count as bigint) AS follow_shop_count,
      {sql_time('first_visit_time')} AS first_visit_time, {sql_time('last_visit_time')} AS last_visit_time
    FROM visit_agg"""))
def user_visit_agg(spark, sf):
    return dws.user_visit(derive.behavior_log(_events(spark, sf)))


PAYMENT_AGG = query(f"""
    SELECT user_id, dt, payment_count, cast(payment_amount as double) AS payment_amount, shop_count,
      {sql_time('first_payment_time')} AS first_payment_time, {sql_time('last_payment_time')} AS last_payment_time
    FROM payment_agg""")


@check("a1_trade_payment_agg", PAYMENT_AGG)
def a1_trade_payment_agg(spark, sf):
    return aggregates.trade_payment_agg(joins.payment_fact(*_payments(spark, sf)))


@check("dws_trade_payment_agg", PAYMENT_AGG)
def trade_payment_agg(spark, sf):
    return dws.trade_payment(*_payments(spark, sf))


@check("j13_visit_payment", query("""
    SELECT v.user_id, v.dt, cast(v.new_visit_count as bigint) AS new_visit_count,
      cast(v.return_visit_count as bigint) AS return_visit_count,
      cast(v.purchase_visit_count as bigint) AS purchase_visit_count, p.payment_count,
      cast(p.payment_amount as double) AS payment_amount
    FROM visit_agg v LEFT JOIN payment_agg p ON v.user_id = p.user_id AND v.dt = p.dt"""))
def j13_visit_payment(spark, sf):
    return joins.visit_payment(*_visit_pay(spark, sf))


_SEGMENT = {
    "new": "v.new_visit_count > 0",
    "return": "v.return_visit_count > 0 AND v.new_visit_count = 0",
    "old": "v.purchase_visit_count > 0",
}


def _segment_sql(name: str) -> str:
    return f"""
        SELECT v.dt, count(DISTINCT v.user_id) AS {name}_customers,
          count(DISTINCT CASE WHEN p.payment_count > 0 THEN v.user_id END) AS {name}_payers,
          coalesce(sum(p.payment_amount), 0) AS {name}_amount,
          cast(coalesce(sum(p.payment_count), 0) as bigint) AS {name}_payments
        FROM visit_agg v LEFT JOIN payment_agg p ON v.user_id = p.user_id AND v.dt = p.dt
        WHERE {_SEGMENT[name]} GROUP BY v.dt"""


for _name in _SEGMENT:
    @check(f"a3_segment_{_name}", query(f"""
        SELECT dt, {_name}_customers, {_name}_payers, cast({_name}_amount as double) AS {_name}_amount, {_name}_payments
        FROM ({_segment_sql(_name)})"""))
    def _segment(spark, sf, name=_name):
        return aggregates.segment_metrics(*_visit_pay(spark, sf), name)


def _rounded(n: str, d: str, digits: int) -> str:
    """Exact half-up rounding of a ratio of non-negative integers."""
    unit = 10 ** digits
    return f"cast((2 * cast({n} as hugeint) * {unit} + {d}) // (2 * {d}) as double) / {unit}"


def _analysis_sql(s: str) -> str:
    cents = f"cast({s}_amount * 100 as bigint)"
    return f"""{s}_customers AS {s}_customer_count, {s}_payments AS {s}_customer_payment_count,
      cast({s}_amount as double) AS {s}_customer_payment_amount,
      CASE WHEN {s}_customers > 0 THEN {_rounded(f'{s}_payers', f'{s}_customers', 4)} ELSE 0 END
        AS {s}_customer_conversion_rate,
      CASE WHEN {s}_payers > 0 THEN {_rounded(cents, f'{s}_payers', 0)} / 100 ELSE 0 END
        AS {s}_customer_avg_order_value"""


ANALYSIS = query(f"""
    SELECT coalesce(n.dt, r.dt, o.dt) AS stat_date, {', '.join(_analysis_sql(s) for s in _SEGMENT)}
    FROM ({_segment_sql('new')}) n
    FULL OUTER JOIN ({_segment_sql('return')}) r ON n.dt = r.dt
    FULL OUTER JOIN ({_segment_sql('old')}) o ON coalesce(n.dt, r.dt) = o.dt""")


@check("ads_customer_analysis", ANALYSIS)
def customer_analysis(spark, sf):
    return ads.customer_analysis(*_visit_pay(spark, sf))


@check("j8_segment_full_join", ANALYSIS)
def j8_segment_full_join(spark, sf):
    return aggregates.customer_analysis_by_join(*_visit_pay(spark, sf))


@check("ads_realtime_dashboard", query(f"""
    SELECT 'today_gmv' AS metric_key, cast(cast(sum(pay_amount) as decimal(20,2)) as varchar) AS metric_value
    FROM payment_fact WHERE dt = '{DASHBOARD_DAY}' GROUP BY dt
    UNION ALL SELECT 'today_order_count', cast(count(*) as varchar) FROM payment_fact WHERE dt = '{DASHBOARD_DAY}'
    UNION ALL SELECT 'today_customer_count', cast(count(DISTINCT user_id) as varchar)
    FROM payment_fact WHERE dt = '{DASHBOARD_DAY}'"""))
def realtime_dashboard(spark, sf):
    return ads.realtime_dashboard(dwd.paid(_payments(spark, sf)[0]), DASHBOARD_DAY)


@check("p5_behavior_flags", query("""
    SELECT user_id, page_url, is_follow_shop, visit_type = 'new' AS is_new_visit,
      visit_type IN ('return', 'return_no_buy') AS is_return_visit, visit_type = 'purchase' AS is_purchase_visit
    FROM behavior_log"""))
def p5_behavior_flags(spark, sf):
    flagged = projections.behavior_flags(derive.behavior_log(_events(spark, sf)))
    return flagged.select(
        "user_id", "page_url", "is_follow_shop", "is_new_visit", "is_return_visit", "is_purchase_visit"
    )


@check("p8_filter_day", query(f"SELECT pay_id, user_id, dt FROM payment_fact WHERE dt = '{DASHBOARD_DAY}'"))
def p8_filter_day(spark, sf):
    fact = dwd.trade_payment_fact(*_payments(spark, sf))
    return projections.filter_day(fact, DASHBOARD_DAY, time="pay_time").select("pay_id", "user_id", "dt")


@check("s4b_camel_case", """
    SELECT o_orderkey AS "oOrderkey", o_orderstatus AS "oOrderstatus", o_totalprice AS "oTotalprice" FROM orders""")
def s4b_camel_case(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return projections.rename_snake_to_camel(rows)
