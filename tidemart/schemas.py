"""Input and output schemas of the warehouse tables, as Spark DDL text."""

from __future__ import annotations

# Change record as delivered: before/after stay JSON text until a table is chosen.
CDC_ENVELOPE = "op STRING, before STRING, after STRING, source MAP<STRING,STRING>, ts_ms BIGINT"

# Row of each captured table.
CDC_TABLES = {
    "cart_info": (
        "is_ordered STRING, cart_price STRING, sku_num BIGINT, create_time BIGINT, user_id STRING, "
        "sku_id STRING, sku_name STRING, id STRING, operate_time BIGINT"
    ),
    "comment_info": (
        "create_time BIGINT, user_id STRING, appraise STRING, comment_txt STRING, nick_name STRING, "
        "sku_id STRING, id STRING, spu_id STRING, order_id STRING"
    ),
    "order_detail": (
        "sku_num BIGINT, create_time BIGINT, split_coupon_amount STRING, sku_id BIGINT, sku_name STRING, "
        "order_price STRING, id BIGINT, order_id BIGINT, split_activity_amount STRING, "
        "split_total_amount STRING"
    ),
    "order_info": (
        "payment_way BIGINT, consignee STRING, create_time BIGINT, refundable_time BIGINT, "
        "original_total_amount STRING, coupon_reduce_amount STRING, order_status BIGINT, "
        "out_trade_no BIGINT, total_amount STRING, user_id BIGINT, province_id BIGINT, "
        "consignee_tel STRING, trade_body STRING, id BIGINT, activity_reduce_amount STRING, "
        "operate_time BIGINT"
    ),
    "order_detail_activity": (
        "order_detail_id BIGINT, create_time BIGINT, activity_rule_id BIGINT, activity_id BIGINT, "
        "sku_id BIGINT, id BIGINT, order_id BIGINT"
    ),
    "order_detail_coupon": (
        "order_detail_id BIGINT, coupon_id BIGINT, create_time BIGINT, sku_id BIGINT, id BIGINT, "
        "order_id BIGINT, coupon_use_id BIGINT"
    ),
    "order_refund_info": (
        "refund_type STRING, refund_status STRING, create_time BIGINT, user_id BIGINT, refund_num BIGINT, "
        "refund_reason_type STRING, refund_amount STRING, sku_id BIGINT, id BIGINT, order_id BIGINT, "
        "refund_reason_txt STRING"
    ),
    "payment_info": (
        "callback_time BIGINT, payment_type STRING, out_trade_no STRING, create_time BIGINT, "
        "user_id BIGINT, total_amount STRING, subject STRING, payment_status STRING, "
        "callback_content STRING, id BIGINT, order_id BIGINT, operate_time BIGINT"
    ),
    "refund_payment": (
        "callback_time BIGINT, payment_type STRING, refund_status STRING, create_time BIGINT, "
        "total_amount STRING, subject STRING, trade_no STRING, sku_id BIGINT, callback_content STRING, "
        "id BIGINT, order_id BIGINT, operate_time BIGINT"
    ),
    "sku_info": (
        "is_sale BIGINT, sku_desc STRING, tm_id BIGINT, create_time BIGINT, price STRING, "
        "sku_default_img STRING, weight STRING, sku_name STRING, id BIGINT, spu_id BIGINT, "
        "category3_id BIGINT"
    ),
    "table_process_dim": (
        "source_table STRING, sink_table STRING, sink_columns STRING, sink_family STRING, "
        "sink_row_key STRING"
    ),
}

# Columns of the captured tables that the order, payment and refund facts are made of; their
# states keep no others.
_FACT_COLUMNS = {
    "order_detail": (
        "id order_id sku_id sku_name create_time sku_num split_activity_amount split_coupon_amount split_total_amount"
    ),
    "order_info": "id user_id province_id order_status operate_time",
    "order_detail_activity": "id order_id order_detail_id activity_id activity_rule_id",
    "order_detail_coupon": "id order_id order_detail_id coupon_id",
    "order_refund_info": (
        "id user_id order_id sku_id create_time refund_type refund_status refund_reason_type refund_reason_txt "
        "refund_num refund_amount"
    ),
    "payment_info": "id order_id payment_status payment_type callback_time create_time",
    "refund_payment": "id order_id sku_id refund_status payment_type callback_time create_time total_amount",
}
FACT_TABLES = {
    table: ", ".join(f for f in CDC_TABLES[table].split(", ") if f.split()[0] in names.split())
    for table, names in _FACT_COLUMNS.items()
}

# Column lists of the seven relational tables copied to topics; types follow the
# column names (see operators.projections.schema_from_names).
ODS_COLUMNS = {
    "ods_user_behavior_log": (
        "user_id", "device_id", "visit_type", "event_time", "page_url", "page_type",
        "is_follow_shop", "proc_time",
    ),
    "ods_trade_order": (
        "order_id", "user_id", "order_time", "pay_amount", "is_paid", "order_status",
        "goods_type", "goods_id", "shop_id",
    ),
    "ods_trade_payment": (
        "pay_id", "order_id", "pay_time", "pay_amount", "pay_method", "pay_status", "user_id",
    ),
    "ods_goods_operation_log": (
        "id", "goods_id", "operate_type", "operate_time", "price", "stock_num", "operate_content",
    ),
    "ods_marketing_activity_log": (
        "id", "activity_id", "user_id", "activity_type", "get_time", "use_time",
        "coupon_amount", "coupon_code",
    ),
    "ods_user_register_log": (
        "user_id", "register_time", "register_channel", "device_id", "register_ip",
    ),
    "ods_shop_operation_log": (
        "id", "shop_id", "operate_type", "operate_time", "operate_content", "operator_id",
    ),
}

# Config-routed dimension: every source field as text.
ROUTED_DIM = "rowkey STRING, info MAP<STRING,STRING>"

WIDE_ORDER_DETAIL = (
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "date_id", "create_time", "sku_num",
    "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts",
)

# Codes that select rows (fixed values).
ORDER_CANCELLED = 1003
ORDER_REFUNDING = 1005
ORDER_REFUNDED = 1006
PAYMENT_PAID = "1602"
REFUND_PAID = "1602"
REFUND_APPROVED = "0705"
PAY_SUCCESS = "success"
