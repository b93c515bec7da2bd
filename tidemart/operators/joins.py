"""Joins of facts, states and dimensions.

Dimension sides carry no broadcast hint: Spark broadcasts a side whose
estimated or measured size is under its limit and shuffles both otherwise. Fact
joins go through ``keyed_join`` so adaptive execution can split a hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions import times
from tidemart.functions.jsonio import amount
from tidemart.functions.keys import md5_key

UNKNOWN_BRAND = "未知品牌"  # fixed value: brand name when the dimension has none
UNKNOWN_NAME = "N/A"  # fixed value: dictionary name when the code is absent


def keyed_join(
    left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi join in which either input may come from a per-key aggregate or window.

    Such an input is already partitioned by the key, so Spark would join it
    without a new exchange, and adaptive execution splits a skewed partition only
    between two exchanges. A second key, the hash of the first, gives both sides
    an exchange; the result is that of the plain join. A few bits of the hash do: all of
    them would be eight bytes of every shuffled row that cannot be compressed. Right columns that repeat
    a left name are dropped by the caller's selection beforehand.
    """
    left = left.withColumn("_lh", F.pmod(F.xxhash64(*left_on), F.lit(16)))
    right = right.withColumn("_rh", F.pmod(F.xxhash64(*right_on), F.lit(16)))
    condition: Column = F.col("_lh") == F.col("_rh")
    for a, b in zip(left_on, right_on, strict=True):
        condition = condition & (F.col(a) == F.col(b))
    return left.join(right, condition, how).drop("_lh", "_rh")


def plain_join(
    left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """In place of ``keyed_join``, for sides that lie by the key already and are not to be shuffled again."""
    return left.join(right, reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(left_on, right_on, strict=True)]), how)


def null_safe_semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose key occurs on the right; null is a key like any other."""
    right = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)])
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return left.join(right, condition, "left_semi")


def interval_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, left_time: str, right_time: str,
    lower: int, upper: int,
) -> DataFrame:
    """Inner join on a key where right time is in [left time + lower, left time + upper] seconds.

    Both sides are also keyed by a time bucket as wide as the interval: a right
    row has one bucket, a left row the at most two its interval touches. Rows of
    a key holding a large share of the data then meet only their neighbours in
    time, in many tasks.
    """
    width = max(upper - lower, 1) * 1_000_000

    def bucket(t: Column, seconds: int) -> Column:
        return F.call_function("div", F.unix_micros(t) + F.lit(seconds * 1_000_000), F.lit(width))

    lt, rt = F.col(left_time), F.col(right_time)
    left = left.withColumn("_lb", F.explode(F.sequence(bucket(lt, lower), bucket(lt, upper))))
    right = right.withColumn("_rb", bucket(rt, 0))
    inside = (F.unix_micros(rt) - F.unix_micros(lt)).between(lower * 1_000_000, upper * 1_000_000)
    return left.join(
        right, (F.col(left_on) == F.col(right_on)) & (F.col("_lb") == F.col("_rb")) & inside
    ).drop("_lb", "_rb")


def within(left_time: str, right_time: str, lower: str, upper: str) -> Column:
    """The same bound as a plain condition, for joins of two streams."""
    lt, rt = F.col(left_time), F.col(right_time)
    return (rt >= lt + F.expr(f"interval {lower}")) & (rt <= lt + F.expr(f"interval {upper}"))


# -- dimension lookups ---------------------------------------------------------

def dim_names(dim: DataFrame, name: str, code: str = "_code") -> DataFrame:
    """Code and name of a dictionary-style dimension."""
    return dim.select(F.col("dic_code").alias(code), F.col("info.dic_name").alias(name))


def lookup_join(
    df: DataFrame, dim: DataFrame, key: str | Column, name: str = "dic_name", how: str = "inner",
    default: str | None = None,
) -> DataFrame:
    """Add a dimension's name; an inner lookup drops rows without a dimension row."""
    column = (F.col(key) if isinstance(key, str) else key).cast("string")
    out = df.join(dim_names(dim, name), column == F.col("_code"), how).drop("_code")
    return out.withColumn(name, F.coalesce(name, F.lit(default))) if default is not None else out


def hashed_lookup(df: DataFrame, dim: DataFrame, key: str, name: str = "dic_name") -> DataFrame:
    """Left lookup of a dimension whose row key is the md5 of the code."""
    names = dim.select(F.col("rowkey").alias("_rowkey"), F.col("info.dic_name").alias(name))
    out = df.join(names, md5_key(F.col(key)) == F.col("_rowkey"), "left").drop("_rowkey")
    return out.withColumn(name, F.coalesce(name, F.lit(UNKNOWN_NAME)))


# -- relational family ---------------------------------------------------------

def payment_fact(pay: DataFrame, orders: DataFrame) -> DataFrame:
    """Successful payments with the goods of their order, if known."""
    paid = pay.filter(F.col("pay_status") == schemas.PAY_SUCCESS)
    goods = orders.select(F.col("order_id").alias("_order"), "goods_type", "goods_id", "shop_id")
    return keyed_join(paid, goods, ["order_id"], ["_order"], "left").select(
        "pay_id", "order_id", "user_id", "pay_time", "pay_amount", "pay_method", "pay_status",
        "goods_type", "goods_id", "shop_id", times.day_text(F.col("pay_time")).alias("dt"),
    )


def visit_payment(visit: DataFrame, pay: DataFrame) -> DataFrame:
    """Each user's day of visits with that day's payments, if any."""
    return visit.select(
        "user_id", "dt", "new_visit_count", "return_visit_count", "purchase_visit_count"
    ).join(pay.select("user_id", "dt", "payment_count", "payment_amount"), ["user_id", "dt"], "left")


def merge_segments(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Chain of full outer joins on one key, coalesced after each step."""
    merged = frames[0]
    for i, frame in enumerate(frames[1:]):
        other = frame.withColumnRenamed(key, f"_k{i}")
        merged = merged.join(other, F.col(key) == F.col(f"_k{i}"), "full")
        merged = merged.withColumn(key, F.coalesce(key, f"_k{i}")).drop(f"_k{i}")
    return merged


# -- change-capture family -------------------------------------------------------

def order_detail_wide(
    detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame,
    carry: Sequence[str] = (), keep: Sequence[str] = (), join: Callable[..., DataFrame] = keyed_join,
    by_line: bool = False,
) -> DataFrame:
    """Order lines with their order, and activity and coupon if any.

    ``carry`` names more order columns, ``keep`` more line columns to pass on. ``join`` joins lines and orders.

    The order comes first: an inner join with few orders leaves few lines for the rest. With ``by_line`` it comes last:
    lines of a state lie by their id already, meet activity and coupon where they are and are shuffled once, for the order.
    """
    od = detail.select(
        "id", "order_id", "sku_id", "sku_name", "create_time", "sku_num",
        "split_activity_amount", "split_coupon_amount", "split_total_amount", *keep,
    )
    oi = orders.select(F.col("id").alias("_order"), "user_id", F.col("province_id").cast("string"), *carry)
    act = activity.select(F.col("order_detail_id").alias("_act"), "activity_id", "activity_rule_id")
    cou = coupon.select(F.col("order_detail_id").alias("_cou"), "coupon_id")
    # The two left joins share the line id, so lines are shuffled once for both
    # and once for the order.
    lines = od if by_line else join(od, oi, ["order_id"], ["_order"])
    wide = lines.join(act, F.col("id") == F.col("_act"), "left").join(cou, F.col("id") == F.col("_cou"), "left")
    if by_line:
        wide = join(wide, oi, ["order_id"], ["_order"])
    return wide.withColumns({
        "date_id": times.date_id(F.col("create_time")), "ts": F.col("create_time"),
    }).select(*schemas.WIDE_ORDER_DETAIL, *carry, *keep)


def order_cancel(wide: DataFrame, orders: DataFrame, join: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Lines of cancelled orders with the time of cancelling, from the wide lines of all orders.

    ``join`` stands in for ``keyed_join``, as on streams, where state needs a retention.
    """
    cancelled = orders.filter(F.col("order_status") == schemas.ORDER_CANCELLED).select(
        F.col("id").alias("_order"), F.col("operate_time").alias("cancel_time")
    )
    return _cancelled_columns((join or keyed_join)(wide, cancelled, ["order_id"], ["_order"]))


def cancelled_lines(
    detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame, join: Callable[..., DataFrame] = keyed_join
) -> DataFrame:
    """J1 from the captured tables: cancelled orders are picked first, so that only their lines are widened."""
    cancelled = orders.filter(F.col("order_status") == schemas.ORDER_CANCELLED)
    wide = order_detail_wide(detail, cancelled, activity, coupon, carry=("operate_time",), join=join)
    return _cancelled_columns(wide.withColumnRenamed("operate_time", "cancel_time"))


def _cancelled_columns(joined: DataFrame) -> DataFrame:
    columns = ["cancel_time" if c == "create_time" else c for c in schemas.WIDE_ORDER_DETAIL]
    return joined.withColumn("date_id", times.date_id(F.col("create_time"))).select(*columns)


def order_refund(
    refunds: DataFrame, orders: DataFrame, dic: DataFrame, dic_key: str = "order_status"
) -> DataFrame:
    """Refund requests of refunding orders; the dictionary names ``dic_key``."""
    oi = orders.filter(F.col("order_status") == schemas.ORDER_REFUNDING).select(
        F.col("id").alias("_order"), "province_id", "order_status"
    )
    joined = lookup_join(keyed_join(refunds, oi, ["order_id"], ["_order"]), dic, dic_key)
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        times.date_id(F.col("create_time")).alias("date_id"), "create_time", "refund_type", "dic_name",
        "refund_reason_type", "refund_reason_txt", "refund_num", "refund_amount",
        times.event_time(F.col("create_time")).alias("ts"),
    )


#: Payment columns of a paid line.
PAID = ("payment_type", "callback_time", "pay_ts")


def paid_lines(
    payments: DataFrame, lines: DataFrame, time: str = "create_time", lower: int = -30 * 86_400, upper: int = 30
) -> DataFrame:
    """J5, first step: lines with a payment of their order, the line's time from 30 days before to 30 s after it."""
    pi = payments.filter(F.col("payment_status") == schemas.PAYMENT_PAID).select(
        F.col("order_id").alias("_order"), "payment_type", "callback_time",
        times.event_time(F.col("create_time")).alias("pay_ts"),
    )
    od = lines.withColumn("_line_ts", times.event_time(F.col(time)))
    return interval_join(pi, od, "_order", "order_id", "pay_ts", "_line_ts", lower, upper).drop("_order", "_line_ts")


def paid_columns(wide: DataFrame, dic: DataFrame, dic_key: str = "payment_type") -> DataFrame:
    """J5, last step: wide lines with payment columns named and in the fact's form."""
    return lookup_join(wide, dic, dic_key, "payment_type_name").select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name", "province_id",
        "activity_id", "activity_rule_id", "coupon_id", F.col("payment_type").alias("payment_type_code"),
        "payment_type_name", "callback_time", "sku_num", "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"), F.col("pay_ts").alias("ts"),
    )


def payment_success(payments: DataFrame, wide: DataFrame, dic: DataFrame, dic_key: str = "payment_type") -> DataFrame:
    """Paid order lines, from the wide lines of all orders."""
    return paid_columns(paid_lines(payments, wide, "ts"), dic, dic_key)


def refund_pay(
    refund_payments: DataFrame, refunds: DataFrame, orders: DataFrame, dic: DataFrame
) -> DataFrame:
    """Paid refunds with their approved request (order and sku) and refunded order."""
    rp = refund_payments.filter(F.col("refund_status") == schemas.REFUND_PAID)
    ori = refunds.filter(F.col("refund_status") == schemas.REFUND_APPROVED).select(
        F.col("order_id").alias("_ro"), F.col("sku_id").alias("_rs"), "refund_num"
    )
    oi = orders.filter(F.col("order_status") == schemas.ORDER_REFUNDED).select(
        F.col("id").alias("_order"), "user_id", "province_id"
    )
    joined = keyed_join(rp, ori, ["order_id", "sku_id"], ["_ro", "_rs"])
    joined = keyed_join(joined, oi, ["order_id"], ["_order"])
    named = lookup_join(joined, dic, "payment_type", "payment_type_name")
    return named.select(
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type", "payment_type_name",
        times.date_id(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
        "total_amount", times.event_time(F.col("create_time")).alias("ts"),
    )


def comment_named(comments: DataFrame, dic: DataFrame) -> DataFrame:
    """J6 on comments: the name of the appraisal code."""
    return lookup_join(comments, dic, "appraise", "appraise_name").select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt"
    )


def order_province(wide: DataFrame, province: DataFrame) -> DataFrame:
    """J7, first step: province name and event time of every order line."""
    named = lookup_join(wide, province, "province_id", "province_name", "left")
    return named.withColumn("event_time", times.event_time(F.col("ts")))


def typed_amounts(df: DataFrame) -> DataFrame:
    """Split amounts carried as text to exact decimals."""
    names = ("split_activity_amount", "split_coupon_amount", "split_total_amount")
    return df.withColumns({n: amount(F.col(n)) for n in names})


def order_sku_trademark(
    wide: DataFrame, province: DataFrame, sku: DataFrame, trademark: DataFrame
) -> DataFrame:
    """Order lines with province, current sku and brand; a missing brand has a default name."""
    goods = sku.select(F.col("id").alias("_sku"), F.col("sku_name").alias("_sku_name"), "tm_id")
    lines = keyed_join(order_province(wide, province), goods, ["sku_id"], ["_sku"], "left")
    lines = lines.withColumn("sku_name", F.col("_sku_name")).drop("_sku", "_sku_name")
    return lookup_join(lines, trademark, "tm_id", "tm_name", "left", UNKNOWN_BRAND)


def prefixed_merge(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, left_time: str, right_time: str,
    lower: int, upper: int, prefix: str = "info_",
) -> DataFrame:
    """Interval join that adds every right column under a prefix."""
    renamed = right.select(*[F.col(c).alias(prefix + c) for c in right.columns])
    return interval_join(
        left, renamed, left_on, prefix + right_on, left_time, prefix + right_time, lower, upper
    )
