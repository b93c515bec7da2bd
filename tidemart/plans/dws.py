"""Daily summaries and enriched order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.operators import aggregates, joins
from tidemart.plans import dwd


def user_visit(log: DataFrame) -> DataFrame:
    return aggregates.user_visit_agg(dwd.user_behavior_fact(log))


def trade_payment(pay: DataFrame, orders: DataFrame) -> DataFrame:
    return aggregates.trade_payment_agg(dwd.trade_payment_fact(pay, orders))


def order_province(wide: DataFrame, province: DataFrame) -> DataFrame:
    return joins.typed_amounts(joins.order_province(wide, province))


def order_sku_trademark(cdc: DataFrame, wide: DataFrame, province: DataFrame, trademark: DataFrame) -> DataFrame:
    sku = dwd.table_state(cdc, "sku_info")
    return joins.order_sku_trademark(wide, province, sku, trademark)
