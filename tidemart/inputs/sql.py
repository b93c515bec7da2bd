"""The derived inputs as ANSI SQL, for the side-by-side check.

``query(body)`` prefixes a body with the definitions it names, in order.
"""

from __future__ import annotations

import re

from tidemart.inputs.derive import CONFIG_CHANGES, DICTIONARY


def _values(rows: list[tuple], names: str) -> str:
    text = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {text}) AS t({names})"


_MONEY = "cast({} as decimal(16,2))"
_CENTS = "cast(round({} * 100) as bigint)"


def _share(rate: str) -> str:
    return f"cast(cast(cast(l_extendedprice as decimal(16,2)) * cast({rate} as decimal(4,2)) as decimal(16,2)) as varchar)"


_PRICE = "cast(cast(l_extendedprice as decimal(16,2)) as varchar)"

DEFINITIONS: dict[str, str] = {
    "ev": "SELECT *, cast(json_extract_string(props, '$.k') as int) AS k FROM events",
    "behavior_log": """
        SELECT cast(user_id as varchar) AS user_id, 'd_' || user_id AS device_id,
          CASE event_type WHEN 'signup' THEN 'new' WHEN 'view' THEN 'return' WHEN 'click' THEN 'return_no_buy'
            WHEN 'purchase' THEN 'purchase' ELSE 'other' END AS visit_type,
          ts AS event_time, '/page/' || k AS page_url, event_type AS page_type, k >= 50 AS is_follow_shop,
          ts AS proc_time
        FROM ev""",
    "trade_order": """
        SELECT cast(event_id as varchar) AS order_id, cast(user_id as varchar) AS user_id, ts AS order_time,
          cast(value as decimal(10,2)) AS pay_amount, true AS is_paid, 'done' AS order_status,
          CASE WHEN k >= 40 THEN 'book' ELSE 'food' END AS goods_type, 'g_' || k AS goods_id,
          's_' || (k // 10) AS shop_id
        FROM ev WHERE event_type = 'purchase' AND k < 80""",
    "trade_payment": """
        SELECT 'p_' || event_id AS pay_id, cast(event_id as varchar) AS order_id, ts AS pay_time,
          cast(value as decimal(10,2)) AS pay_amount, CASE WHEN k >= 50 THEN 'card' ELSE 'wallet' END AS pay_method,
          CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'pending' END AS pay_status,
          cast(user_id as varchar) AS user_id
        FROM ev WHERE event_type IN ('purchase', 'click')""",
    "behavior_fact": """
        SELECT user_id, device_id, visit_type, event_time, page_type, is_follow_shop,
          visit_type = 'new' AS is_new_visit, visit_type IN ('return', 'return_no_buy') AS is_return_visit,
          visit_type = 'purchase' AS is_purchase_visit, proc_time, strftime(event_time, '%Y-%m-%d') AS dt
        FROM behavior_log""",
    "payment_fact": """
        SELECT p.pay_id, p.order_id, p.user_id, p.pay_time, p.pay_amount, p.pay_method, p.pay_status,
          o.goods_type, o.goods_id, o.shop_id, strftime(p.pay_time, '%Y-%m-%d') AS dt
        FROM trade_payment p LEFT JOIN trade_order o ON p.order_id = o.order_id WHERE p.pay_status = 'success'""",
    "visit_agg": """
        SELECT user_id, dt, count(*) AS visit_count, sum(cast(is_new_visit as int)) AS new_visit_count,
          sum(cast(is_return_visit as int)) AS return_visit_count,
          sum(cast(is_purchase_visit as int)) AS purchase_visit_count,
          sum(cast(is_follow_shop as int)) AS follow_shop_count,
          min(event_time) AS first_visit_time, max(event_time) AS last_visit_time
        FROM behavior_fact GROUP BY user_id, dt""",
    "payment_agg": """
        SELECT user_id, dt, count(pay_id) AS payment_count, sum(pay_amount) AS payment_amount,
          count(DISTINCT shop_id) AS shop_count, min(pay_time) AS first_payment_time, max(pay_time) AS last_payment_time
        FROM payment_fact GROUP BY user_id, dt""",
    "lines": f"""
        SELECT *, epoch_ms(l_shipdate) AS ms, cast('0x' || left(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey,
          l_suppkey, {_CENTS.format('l_quantity')}, {_CENTS.format('l_extendedprice')}, {_CENTS.format('l_discount')},
          {_CENTS.format('l_tax')}, l_returnflag, l_linestatus, epoch_ms(l_shipdate))), 15) as bigint) AS id
        FROM lineitem""",
    "order_detail": f"""
        SELECT cast(l_quantity as bigint) AS sku_num, ms AS create_time, {_share('l_tax')} AS split_coupon_amount,
          l_partkey AS sku_id, 'sku ' || l_partkey AS sku_name, {_PRICE} AS order_price, id,
          l_orderkey AS order_id, {_share('l_discount')} AS split_activity_amount, {_PRICE} AS split_total_amount
        FROM lines""",
    "order_activity": """
        SELECT id AS order_detail_id, ms AS create_time, cast(l_linenumber as bigint) AS activity_rule_id,
          l_suppkey AS activity_id, l_partkey AS sku_id, id, l_orderkey AS order_id
        FROM lines WHERE l_discount >= 0.05""",
    "order_coupon": """
        SELECT id AS order_detail_id, l_suppkey AS coupon_id, ms AS create_time, l_partkey AS sku_id, id,
          l_orderkey AS order_id, cast(l_linenumber as bigint) AS coupon_use_id
        FROM lines WHERE l_returnflag = 'R'""",
    "order_info": f"""
        SELECT c_name AS consignee, epoch_ms(o_orderdate) AS create_time,
          cast(CASE o_orderstatus WHEN 'F' THEN 1003 WHEN 'P' THEN 1005 ELSE 1006 END as bigint) AS order_status,
          cast({_MONEY.format('o_totalprice')} as varchar) AS total_amount, o_custkey AS user_id,
          cast(c_nationkey as bigint) AS province_id, o_orderpriority AS trade_body, o_orderkey AS id,
          epoch_ms(o_orderdate) + 3600000 AS operate_time
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "payment_info": f"""
        SELECT epoch_ms(o_orderdate) + 86460000 AS callback_time,
          CASE WHEN o_orderpriority < '3' THEN '1101' WHEN o_orderpriority < '5' THEN '1102' ELSE '1103' END
            AS payment_type,
          epoch_ms(o_orderdate) + 86400000 AS create_time, o_custkey AS user_id,
          cast({_MONEY.format('o_totalprice')} as varchar) AS total_amount,
          CASE WHEN o_orderstatus = 'O' THEN '1601' ELSE '1602' END AS payment_status,
          o_orderkey AS id, o_orderkey AS order_id
        FROM orders""",
    "refund_info": f"""
        SELECT '1502' AS refund_type, CASE WHEN l_linestatus = 'F' THEN '0705' ELSE '0701' END AS refund_status,
          ms AS create_time, l_suppkey AS user_id, cast(l_quantity as bigint) AS refund_num,
          '1301' AS refund_reason_type, {_PRICE} AS refund_amount, l_partkey AS sku_id, id, l_orderkey AS order_id,
          'line ' || l_linenumber AS refund_reason_txt
        FROM lines WHERE l_returnflag = 'R'""",
    "refund_payment": f"""
        SELECT ms + 86400000 AS callback_time, CASE WHEN l_tax >= 0.04 THEN '1101' ELSE '1102' END AS payment_type,
          CASE WHEN l_discount >= 0.08 THEN '1601' ELSE '1602' END AS refund_status, ms AS create_time,
          {_PRICE} AS total_amount, l_partkey AS sku_id, id, l_orderkey AS order_id
        FROM lines WHERE l_returnflag = 'R'""",
    "cart_info": f"""
        SELECT CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS is_ordered,
          cast({_MONEY.format('value')} as varchar) AS cart_price, cast(k as bigint) AS sku_num,
          epoch_us(ts) // 1000 AS create_time, cast(user_id as varchar) AS user_id, cast(k as varchar) AS sku_id,
          'sku ' || k AS sku_name, cast(event_id as varchar) AS id, epoch_us(ts) // 1000 AS operate_time
        FROM ev""",
    "cart_now": "SELECT * FROM cart_info WHERE NOT (is_ordered = '0' AND sku_num < 20)",
    "comment_info": """
        SELECT 1700000000000 + (conv_id * 100000 + turn) * 10 AS create_time, cast(conv_id as varchar) AS user_id,
          CASE role WHEN 'user' THEN '1201' WHEN 'assistant' THEN '1202' ELSE '1203' END AS appraise,
          text AS comment_txt, role AS nick_name, cast(turn as varchar) AS sku_id,
          cast(conv_id * 100000 + turn as varchar) AS id, cast(turn as varchar) AS spu_id,
          cast(conv_id as varchar) AS order_id
        FROM conversations""",
    "sku_info": f"""
        SELECT cast(string_split(p_brand, '#')[-1] as bigint) AS tm_id, p_name AS sku_name, p_partkey AS id,
          cast({_MONEY.format('p_retailprice')} as varchar) AS price, p_type AS sku_desc,
          cast(p_size as varchar) AS weight, cast(p_size as bigint) AS spu_id
        FROM part""",
    "dic": _values(list(DICTIONARY.items()), "dic_code, dic_name"),
    "province": "SELECT cast(n_nationkey as varchar) AS dic_code, n_name AS dic_name FROM nation WHERE n_regionkey <> 3",
    "trademark": """
        SELECT DISTINCT string_split(p_brand, '#')[-1] AS dic_code, p_brand AS dic_name
        FROM part WHERE p_brand <> 'Brand#13'""",
    "config_changes": _values(CONFIG_CHANGES, "op, source_table, sink_table, sink_row_key, sink_columns, ts_ms"),
    "wide": """
        SELECT od.id, od.order_id, oi.user_id, od.sku_id, od.sku_name, cast(oi.province_id as varchar) AS province_id,
          act.activity_id, act.activity_rule_id, cou.coupon_id,
          cast(epoch(date_trunc('day', epoch_ms(od.create_time))) as bigint) AS date_id, od.create_time, od.sku_num,
          od.split_activity_amount, od.split_coupon_amount, od.split_total_amount, od.create_time AS ts
        FROM order_detail od JOIN order_info oi ON od.order_id = oi.id
          LEFT JOIN order_activity act ON od.id = act.order_detail_id
          LEFT JOIN order_coupon cou ON od.id = cou.order_detail_id""",
    "log_parts": """
        SELECT event_id AS log_id, event_type AS kind, k, ts, epoch_us(ts) // 1000 AS ms, 'd_' || user_id AS mid,
          cast(user_id as varchar) AS uid, CASE WHEN event_type = 'signup' OR k < 30 THEN '1' ELSE '0' END AS raw_new,
          CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN NULL
            ELSE 'cart' END AS page_id,
          event_type = 'error' AND k >= 90 AS dirty
        FROM ev""",
    "first_visit": """
        SELECT mid, CASE WHEN arg_min(raw_new, log_id) = '1' THEN arg_min(cast(ts as date), log_id)
          ELSE arg_min(cast(ts as date), log_id) - 1 END AS first_day
        FROM log_parts WHERE NOT dirty GROUP BY mid""",
    "fixed_log": """
        SELECT l.*, CASE WHEN raw_new = '1' AND first_day <> cast(ts as date) THEN '0' ELSE raw_new END AS is_new
        FROM log_parts l JOIN first_visit f ON l.mid = f.mid WHERE NOT dirty""",
    "log_json": """
        SELECT *,
          '{"is_new":"' || is_new || '","mid":"' || mid || '","uid":"' || uid || '"}' AS common_j,
          '{"item":"' || k || '","page_id":"' || page_id || '"}' AS page_j,
          CASE WHEN kind = 'error' OR (kind = 'signup' AND k >= 80)
            THEN '{"code":' || k || ',"msg":"e' || k || '"}' END AS err_j
        FROM fixed_log""",
    "messages": """
        SELECT conv_id AS user_id, role AS info_consignee, conv_id * 100000 + turn AS ts_ms, '20240101' AS ds,
          text AS comment_txt, string_split(regexp_replace(text, ',+$', ''), ',')[-1] AS token, role
        FROM conversations""",
    "words": "SELECT DISTINCT token AS word FROM messages WHERE role = 'user' AND token <> ''",
}


def query(body: str) -> str:
    """The body with a WITH clause of every definition it uses, directly or not."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in DEFINITIONS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(DEFINITIONS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({DEFINITIONS[n].strip()})" for n in needed) + "\n" + body.strip()
