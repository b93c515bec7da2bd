"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tidemart.functions.jsonio import safe_ratio
from tidemart.operators.joins import merge_segments, visit_payment

MONEY = "decimal(20,2)"

# Which user days belong to a segment. Segments may overlap.
SEGMENTS = {
    "new": "new_visit_count > 0",
    "return": "return_visit_count > 0 AND new_visit_count = 0",
    "old": "purchase_visit_count > 0",
}


def trade_payment_agg(fact: DataFrame) -> DataFrame:
    """A1: payments of each user and day."""
    return fact.groupBy("user_id", "dt").agg(
        F.count("pay_id").alias("payment_count"),
        F.sum("pay_amount").cast(MONEY).alias("payment_amount"),
        F.count_distinct("shop_id").alias("shop_count"),
        F.min("pay_time").alias("first_payment_time"),
        F.max("pay_time").alias("last_payment_time"),
    )


def user_visit_agg(fact: DataFrame) -> DataFrame:
    """A2: visits of each user and day."""

    def flag(name: str) -> Column:
        return F.sum(F.col(name).cast("int"))

    return fact.groupBy("user_id", "dt").agg(
        F.count(F.lit(1)).alias("visit_count"),
        flag("is_new_visit").alias("new_visit_count"),
        flag("is_return_visit").alias("return_visit_count"),
        flag("is_purchase_visit").alias("purchase_visit_count"),
        flag("is_follow_shop").alias("follow_shop_count"),
        F.min("event_time").alias("first_visit_time"),
        F.max("event_time").alias("last_visit_time"),
    )


def _segment_columns(name: str, member: Column) -> list[Column]:
    payer = member & (F.col("payment_count") > 0)
    return [
        F.count(F.when(member, 1)).alias(f"{name}_customers"),
        F.count(F.when(payer, 1)).alias(f"{name}_payers"),
        F.coalesce(F.sum(F.when(member, F.col("payment_amount"))), F.lit(0)).cast(MONEY).alias(f"{name}_amount"),
        F.coalesce(F.sum(F.when(member, F.col("payment_count"))), F.lit(0)).alias(f"{name}_payments"),
    ]


def _per_user(days: DataFrame, members: dict[str, str]) -> DataFrame:
    """One row per user and day, so that customers can be counted without a distinct.

    Input that already has one row per user and day keeps its partitioning, and
    this step adds no shuffle.
    """
    flags = [F.max(F.expr(rule)).alias(f"_{name}") for name, rule in members.items()]
    return days.groupBy("user_id", "dt").agg(
        *flags,
        F.sum("payment_count").alias("payment_count"),
        F.sum("payment_amount").alias("payment_amount"),
    )


def segment_metrics(visit: DataFrame, pay: DataFrame, segment: str) -> DataFrame:
    """A3: customers, payers, amount and payments of one segment per day."""
    days = visit_payment(visit, pay).filter(SEGMENTS[segment])
    users = _per_user(days, {segment: SEGMENTS[segment]})
    return users.groupBy("dt").agg(*_segment_columns(segment, F.col(f"_{segment}")))


def _analysis_columns(name: str) -> list[Column]:
    customers, payers = F.col(f"{name}_customers"), F.col(f"{name}_payers")
    return [
        customers.alias(f"{name}_customer_count"),
        F.col(f"{name}_payments").alias(f"{name}_customer_payment_count"),
        F.col(f"{name}_amount").cast(MONEY).alias(f"{name}_customer_payment_amount"),
        safe_ratio(payers.cast("decimal(20,1)"), customers).cast("decimal(5,4)")
        .alias(f"{name}_customer_conversion_rate"),
        safe_ratio(F.col(f"{name}_amount"), payers).cast(MONEY)
        .alias(f"{name}_customer_avg_order_value"),
    ]


def customer_analysis(visit: DataFrame, pay: DataFrame) -> DataFrame:
    """J8 as one pass: all segments from one join and one aggregation per day.

    A segment without customers on a day has null counts and zero ratios, as the
    full outer join of the separate segments gives.
    """
    days = visit_payment(visit, pay)
    users = days.groupBy("user_id", "dt").agg(
        *[c for n, rule in SEGMENTS.items() for c in (
            F.max(F.expr(rule)).alias(f"_{n}"),
            F.sum(F.when(F.expr(rule), F.col("payment_count"))).alias(f"_{n}_payments"),
            F.sum(F.when(F.expr(rule), F.col("payment_amount"))).alias(f"_{n}_amount"),
        )]
    )
    columns = []
    for n in SEGMENTS:
        member = F.col(f"_{n}")
        columns += [
            F.count(F.when(member, 1)).alias(f"_{n}_n"),
            F.count(F.when(member & (F.col(f"_{n}_payments") > 0), 1)).alias(f"_{n}_p"),
            F.coalesce(F.sum(f"_{n}_amount"), F.lit(0)).cast(MONEY).alias(f"_{n}_a"),
            F.coalesce(F.sum(f"_{n}_payments"), F.lit(0)).alias(f"_{n}_c"),
        ]
    daily = users.groupBy("dt").agg(*columns)
    present = F.lit(False)
    parts = [F.col("dt")]
    for n in SEGMENTS:
        some = F.col(f"_{n}_n") > 0
        present = present | some
        parts += [
            F.when(some, F.col(f"_{n}_n")).alias(f"{n}_customers"),
            F.when(some, F.col(f"_{n}_p")).alias(f"{n}_payers"),
            F.when(some, F.col(f"_{n}_a")).alias(f"{n}_amount"),
            F.when(some, F.col(f"_{n}_c")).alias(f"{n}_payments"),
        ]
    return _analysis(daily.filter(present).select(*parts))


def customer_analysis_by_join(visit: DataFrame, pay: DataFrame) -> DataFrame:
    """J8 as written: three segments joined full outer on the day."""
    return _analysis(merge_segments([segment_metrics(visit, pay, s) for s in SEGMENTS], "dt"))


def _analysis(merged: DataFrame) -> DataFrame:
    return merged.select(
        F.col("dt").alias("stat_date"), *[c for s in SEGMENTS for c in _analysis_columns(s)]
    )


def dashboard(day_fact: DataFrame) -> DataFrame:
    """A4: one day's amount, orders and customers as key and text value.

    One aggregation feeds all three; without payments there is no amount row.
    """
    totals = day_fact.agg(
        F.sum("pay_amount").cast(MONEY).cast("string").alias("gmv"),
        F.count(F.lit(1)).cast("string").alias("orders"),
        F.count_distinct("user_id").cast("string").alias("customers"),
    )
    return totals.selectExpr(
        "stack(3, 'today_gmv', gmv, 'today_order_count', orders, 'today_customer_count', customers)"
        " AS (metric_key, metric_value)"
    ).filter("metric_value IS NOT NULL")


def new_old_users(log: DataFrame) -> DataFrame:
    """Per day, logins of users first and not first seen that day.

    Logins are counted per user and day first; the window over a user then sees
    at most one row per day however often that user logged in.
    """
    daily = log.groupBy("user_id", "login_date").agg(F.count(F.lit(1)).alias("logins"))
    first = F.min("login_date").over(Window.partitionBy("user_id"))
    marked = daily.filter("user_id IS NOT NULL").withColumn("first_login", first)
    return marked.groupBy("login_date").agg(
        F.sum(F.when(F.col("login_date") == F.col("first_login"), F.col("logins")).otherwise(0)).alias("new_users"),
        F.sum(F.when(F.col("login_date") > F.col("first_login"), F.col("logins")).otherwise(0)).alias("old_users"),
    ).orderBy("login_date")


def page_uv(log: DataFrame, length: str = "10 seconds", home: str = "home", detail: str = "good_detail") -> DataFrame:
    """Visitors of the home and the goods detail page per tumbling window.

    Visitors are reduced to one row per window first. Works on a batch and, with
    a watermark on ``ts``, on a stream in append mode.
    """
    visitors = page_visitors(log, length, home, detail)
    return _uv_rows(visitors.groupBy(F.window(F.window_time("window"), length)))


def page_visitors(log: DataFrame, length: str = "10 seconds", home: str = "home", detail: str = "good_detail") -> DataFrame:
    """T9, first step alone: one row per window and visitor, for update mode into a keyed table."""
    return log.filter(F.col("page_id").isin(home, detail)).groupBy(F.window("ts", length), "mid").agg(
        F.max((F.col("page_id") == home).cast("int")).alias("_home"),
        F.max((F.col("page_id") == detail).cast("int")).alias("_detail"),
    )


def visitor_counts(visitors: DataFrame) -> DataFrame:
    """T9, second step: the counts of every window from its visitors, open windows too."""
    return _uv_rows(visitors.groupBy("window"))


def _uv_rows(grouped: GroupedData) -> DataFrame:
    counted = grouped.agg(F.sum("_home").alias("home_uv_ct"), F.sum("_detail").alias("good_detail_uv_ct"))
    pattern = "yyyy-MM-dd HH:mm:ss"
    return counted.select(
        F.date_format("window.start", pattern).alias("stt"),
        F.date_format("window.end", pattern).alias("edt"),
        F.date_format("window.start", "yyyy-MM-dd").alias("cur_date"),
        "home_uv_ct",
        "good_detail_uv_ct",
        F.unix_millis("window.start").alias("ts"),
    )
