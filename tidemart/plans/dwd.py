"""Detail facts. Captured tables enter as change records and leave as final state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import times
from tidemart.operators import joins
from tidemart.operators.latest import current_rows, latest_per_key
from tidemart.operators.projections import behavior_flags, cdc_image
from tidemart.operators.routing import cdc_route
from tidemart import schemas
from tidemart.schemas import CDC_TABLES, FACT_TABLES


#: What orders the changes of a row: time, then place in the log.
CHANGE_ORDER = ("ts_ms", "pos")


def table_state(cdc: DataFrame, table: str, key: str = "id") -> DataFrame:
    """Current rows of one captured table."""
    image = cdc_image(cdc_route(cdc, table), FACT_TABLES.get(table, CDC_TABLES[table]), position=True)
    return current_rows(image, [key], CHANGE_ORDER).drop(*CHANGE_ORDER)


def user_behavior_fact(log: DataFrame) -> DataFrame:
    flagged = behavior_flags(log).withColumn("dt", times.day_text(F.col("event_time")))
    return flagged.select(
        "user_id", "device_id", "visit_type", "event_time", "page_type", "is_follow_shop",
        "is_new_visit", "is_return_visit", "is_purchase_visit", "proc_time", "dt",
    )


def paid(pay: DataFrame) -> DataFrame:
    """The fact's payment columns: the latest row of each successful payment, without the goods."""
    done = pay.filter(F.col("pay_status") == schemas.PAY_SUCCESS)
    return latest_per_key(done, ["pay_id"], ["pay_time"]).withColumn("dt", times.day_text(F.col("pay_time")))


def trade_payment_fact(pay: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment with the current goods of its order."""
    order_state = latest_per_key(orders, ["order_id"], ["order_time"])
    # Orders are unique here, so the left join repeats no payment and the latest one may be taken first.
    return joins.payment_fact(paid(pay).drop("dt"), order_state)


def cart_info(cdc: DataFrame) -> DataFrame:
    return table_state(cdc, "cart_info")


def comment_info(cdc: DataFrame, dic: DataFrame) -> DataFrame:
    return joins.comment_named(table_state(cdc, "comment_info"), dic)


def order_detail(cdc: DataFrame) -> DataFrame:
    return joins.order_detail_wide(
        table_state(cdc, "order_detail"), table_state(cdc, "order_info"),
        table_state(cdc, "order_detail_activity"), table_state(cdc, "order_detail_coupon"), by_line=True,
    )


def order_cancel(cdc: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """From stored wide lines if given, else from the captured tables, each built once."""
    if wide is not None:
        return joins.order_cancel(wide, table_state(cdc, "order_info"))
    return joins.cancelled_lines(
        table_state(cdc, "order_detail"), table_state(cdc, "order_info"),
        table_state(cdc, "order_detail_activity"), table_state(cdc, "order_detail_coupon"),
    )


def order_refund(cdc: DataFrame, dic: DataFrame) -> DataFrame:
    return joins.order_refund(table_state(cdc, "order_refund_info"), table_state(cdc, "order_info"), dic)


def payment_success(cdc: DataFrame, dic: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """From stored wide lines if given, else from the captured tables: lines meet their payments before they are widened."""
    payments = table_state(cdc, "payment_info")
    if wide is None:
        detail = joins.paid_lines(payments, table_state(cdc, "order_detail"))
        wide = joins.order_detail_wide(
            detail, table_state(cdc, "order_info"), table_state(cdc, "order_detail_activity"),
            table_state(cdc, "order_detail_coupon"), keep=joins.PAID)
        return latest_per_key(joins.paid_columns(wide, dic), ["order_detail_id"], ["ts", "callback_time"])
    paid = joins.payment_success(payments, wide, dic)
    return latest_per_key(paid, ["order_detail_id"], ["ts", "callback_time"])


def refund_pay(cdc: DataFrame, dic: DataFrame) -> DataFrame:
    """One row per refund payment; of several requests for one sku the largest number counts."""
    paid = joins.refund_pay(
        table_state(cdc, "refund_payment"), table_state(cdc, "order_refund_info"),
        table_state(cdc, "order_info"), dic,
    )
    return latest_per_key(paid, ["id"], ["ts", "refund_num"])
