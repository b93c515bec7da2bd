"""Payments kept current on a stream (J2, A1, A4): facts, sums per user and day, the dashboard of the day.

A micro-batch of payment and order changes becomes signed rows of the payment fact: the row as
it was with -1, the row as it is with +1, for the orders touched alone. Sums follow from
the signs. What signs cannot undo is kept as counted sets: a distinct value is gone when its
count falls to zero, and a group whose first or last time was taken back takes it anew
from the times that are left. All state is in bucketed keyed tables, a batch reads the
buckets it touches, and each step writes under its batch number, so a batch run again
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators import joins
from tidemart.operators.aggregates import MONEY
from tidemart.operators.latest import latest_per_key
from tidemart.sinks.upsert import UpsertTable
from tidemart.streaming.jobs import batch_job

BUCKETS = 16
#: Parts of the dashboard's one global group.
SHARDS = 16
SIGN = "_sign"
#: What orders the changes of a payment or an order: the place in its log.
POSITION = "pos"
_PAYMENT = "pay_id: string, order_id: string, pay_time: timestamp, pay_amount: decimal(10,2), pay_method: string, pay_status: string, user_id: string"
_ORDER = "order_id: string, order_time: timestamp, goods_type: string, goods_id: string, shop_id: string"
#: Changes of payments and of orders in one stream, each with its row.
FEED = f"kind string, op string, {POSITION} bigint, payment struct<{_PAYMENT}>, `order` struct<{_ORDER}>"


Keep = Callable[[DataFrame], DataFrame]


@contextmanager
def kept() -> Iterator[Keep]:
    """Frames that a step uses more than once are computed once and let go at its end."""
    frames: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        frames.append(df.persist())
        return df

    try:
        yield keep
    finally:
        for df in frames:
            df.unpersist()


def _rows(batch: DataFrame, kind: str) -> DataFrame:
    return batch.filter(F.col("kind") == kind).select(f"{kind}.*", "op", POSITION)


def _before(table: UpsertTable, spark: SparkSession, batch_id: int, near: Sequence[int]) -> DataFrame | None:
    return table.read(spark, batch_id, near) if table.written(spark, batch_id) else None


def signed(was: DataFrame | None, now: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that changed between two states of the same keys: as they were with -1, as they are with +1."""
    names = now.columns
    new = now.select(F.struct(F.lit(1).alias(SIGN), *names).alias("_new"))
    if was is None:
        return new.select("_new.*")
    old = was.select(F.struct(F.lit(-1).alias(SIGN), *names).alias("_old"))

    def equal(columns: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in columns])

    there = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    sides = F.filter(F.array("_old", "_new"), lambda side: side.isNotNull())
    return old.join(new, equal(keys), "full_outer").filter(~(there & equal(names))).select(F.inline(sides))


class PaymentFact:
    """J2 on a stream: successful payments with the current goods of their order, whichever comes first.

    All tables are bucketed by order, so a batch reads the orders it touches. A payment that moves to
    another order is deleted at the old one, which ``placed`` remembers; a version older than the one known
    is passed over.
    """

    def __init__(self, root: str, buckets: int = BUCKETS) -> None:
        by_order = {"buckets": buckets, "bucket_by": ["order_id"]}
        self.payments = UpsertTable(f"{root}/payments", ["pay_id", "order_id"], [POSITION], **by_order)
        self.orders = UpsertTable(f"{root}/orders", ["order_id"], [POSITION], **by_order)
        self.placed = UpsertTable(f"{root}/placed", ["pay_id"], [POSITION], op="_none", buckets=buckets)
        self.fact = UpsertTable(f"{root}/fact", ["pay_id", "order_id"], **by_order)

    def _settled(self, changes: DataFrame, batch_id: int, keep: Keep) -> DataFrame:
        """The latest change of each payment, with deletes where it moved away."""
        latest = keep(latest_per_key(changes, ["pay_id"], [POSITION]))
        known = _before(self.placed, changes.sparkSession, batch_id, self.placed.touched(latest))
        self.placed.append(latest.select("pay_id", "order_id", POSITION), batch_id, unique=True)
        if known is None:
            return latest
        old = known.select(F.col("pay_id").alias("_pay"), F.col("order_id").alias("_order"), F.col(POSITION).alias("_pos"))
        met = latest.join(old, F.col("pay_id").eqNullSafe(F.col("_pay")), "left")
        met = met.filter(F.col("_pos").isNull() | (F.col(POSITION) >= F.col("_pos")))
        gone = met.filter(F.col("_pos").isNotNull() & ~F.col("order_id").eqNullSafe(F.col("_order")))
        gone = gone.withColumns({"order_id": F.col("_order"), "op": F.lit("d")})
        return met.select(*latest.columns).unionByName(gone.select(*latest.columns))

    def step(self, batch: DataFrame, batch_id: int, keep: Keep) -> DataFrame:
        """Take in a batch; the signed rows of the fact that it changed."""
        spark = batch.sparkSession
        changes = keep(self._settled(_rows(batch, "payment"), batch_id, keep))
        goods = _rows(batch, "order")
        orders = keep(changes.select("order_id").union(goods.select("order_id")).distinct())
        near = self.fact.touched(orders)
        self.payments.append(changes, batch_id, unique=True)
        self.orders.append(goods, batch_id)

        def of_orders(table: UpsertTable, before: int) -> DataFrame | None:
            rows = _before(table, spark, before, near)
            return None if rows is None else joins.null_safe_semi(rows, orders, ["order_id"])

        rows = joins.payment_fact(
            of_orders(self.payments, batch_id + 1).drop(POSITION), of_orders(self.orders, batch_id + 1).drop(POSITION))
        deltas = keep(signed(of_orders(self.fact, batch_id), rows, self.fact.keys))
        # A payment that stays is written as it is now, one that goes as deleted.
        last = latest_per_key(deltas, self.fact.keys, [SIGN])
        self.fact.append(last.withColumn("op", F.when(F.col(SIGN) > 0, "u").otherwise("d")).drop(SIGN), batch_id, unique=True)
        return deltas

    def read(self, spark: SparkSession) -> DataFrame:
        return self.fact.read(spark)


class CountedSet:
    """Elements of groups with the number of rows that hold each; an element is in the set while that is above zero."""

    def __init__(self, root: str, group: Sequence[str], element: str, buckets: int, bucket_by: Sequence[str]) -> None:
        self.group, self.element = list(group), element
        self.table = UpsertTable(root, [*group, element], buckets=buckets, bucket_by=bucket_by)

    def step(self, deltas: DataFrame, batch_id: int, near: Sequence[int], keep: Keep) -> DataFrame:
        """Take in signed rows; per element that entered or left its group, 1 or -1 as ``change``."""
        keys = [*self.group, self.element]
        rows = deltas.filter(F.col(self.element).isNotNull()).select(*keys, F.col(SIGN).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("was"), F.lit(True).alias("met"))
        known = _before(self.table, deltas.sparkSession, batch_id, near)
        if known is not None:
            rows = rows.unionByName(known.select(*keys, "n", F.col("n").alias("was"), F.lit(False).alias("met")))
        counted = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("was").alias("was"), F.bool_or("met").alias("met"))
        changed = keep(counted.filter("met AND n <> was"))
        marked = changed.select(*keys, "n", F.when(F.col("n") > 0, "u").otherwise("d").alias("op"))
        self.table.append(marked, batch_id, unique=True)
        entered = (F.col("n") > 0).cast("int") - (F.col("was") > 0).cast("int")
        return changed.select(*keys, entered.alias("change")).filter("change <> 0")


class PaymentSums:
    """A1 on a stream: payments of each user and day, with retractions."""

    def __init__(self, root: str, buckets: int = BUCKETS) -> None:
        group = ["user_id", "dt"]
        self.sums = UpsertTable(f"{root}/sums", group, buckets=buckets, bucket_by=["user_id"])
        self.shops = CountedSet(f"{root}/shops", group, "shop_id", buckets, ["user_id"])
        self.times = CountedSet(f"{root}/times", group, "pay_time", buckets, ["user_id"])

    def step(self, deltas: DataFrame, batch_id: int, keep: Keep) -> None:
        spark, group = deltas.sparkSession, ["user_id", "dt"]
        near = self.sums.touched(deltas)
        shops = self.shops.step(deltas, batch_id, near, keep)
        self.times.step(deltas, batch_id, near, keep)
        sign, added = F.col(SIGN).cast("bigint"), F.col(SIGN) > 0
        money = F.col("pay_amount").cast(MONEY)

        def counted(column: str) -> Column:
            return F.when(F.col(column).isNotNull(), sign).otherwise(0)

        nothing = {
            "n": F.lit(0).cast("bigint"), "amounts": F.lit(0).cast("bigint"), "amount": F.lit(0).cast(MONEY), "shops": F.lit(0).cast("bigint"),
            **{c: F.lit(None).cast("timestamp") for c in ("first", "last", "new_first", "new_last", "gone_first", "gone_last")},
            "met": F.lit(True),
        }

        def shaped(df: DataFrame, **columns: Column) -> DataFrame:
            return df.select(*group, *[columns.get(name, value).alias(name) for name, value in nothing.items()])

        time = F.col("pay_time")
        parts = shaped(
            deltas, n=counted("pay_id"), amounts=counted("pay_amount"), amount=F.coalesce(money * sign, F.lit(0)).cast(MONEY),
            new_first=F.when(added, time), new_last=F.when(added, time), gone_first=F.when(~added, time), gone_last=F.when(~added, time))
        parts = parts.unionByName(shaped(shops, shops=F.col("change").cast("bigint")))
        known = _before(self.sums, spark, batch_id, near)
        if known is not None:
            names = ("n", "amounts", "amount", "shops", "first", "last")
            parts = parts.unionByName(shaped(known, **{c: F.col(c) for c in names}, met=F.lit(False)))
        summed = parts.groupBy(*group).agg(
            F.sum("n").alias("n"), F.sum("amounts").alias("amounts"), F.sum("amount").cast(MONEY).alias("amount"),
            F.sum("shops").alias("shops"), F.bool_or("met").alias("met"),
            *[F.min(c).alias(c) for c in ("first", "new_first", "gone_first")],
            *[F.max(c).alias(c) for c in ("last", "new_last", "gone_last")],
        ).filter("met")
        # An extreme that was taken back, and that no new row reaches, is looked for among the times left.
        lost = (F.col("gone_first") <= F.col("first")) & ~F.coalesce(F.col("new_first") <= F.col("first"), F.lit(False))
        lost = F.coalesce(lost, F.lit(False)) | F.coalesce(
            (F.col("gone_last") >= F.col("last")) & ~F.coalesce(F.col("new_last") >= F.col("last"), F.lit(False)), F.lit(False))
        summed = keep(summed.withColumn("lost", lost))
        plain = summed.filter("NOT lost").select(
            *group, "n", "amounts", "amount", "shops", F.least("first", "new_first").alias("first"), F.greatest("last", "new_last").alias("last"))
        if not summed.filter("lost").isEmpty():
            left = joins.null_safe_semi(self.times.table.read(spark, batch_id + 1, near), summed.filter("lost"), group)
            found = left.groupBy(*group).agg(F.min("pay_time").alias("first"), F.max("pay_time").alias("last"))
            again = summed.filter("lost").select(*group, "n", "amounts", "amount", "shops")
            again = again.unionByName(found, allowMissingColumns=True).groupBy(*group).agg(
                *[F.max(c).alias(c) for c in ("n", "amounts", "amount", "shops", "first", "last")])
            plain = plain.unionByName(again)
        self.sums.append(plain.withColumn("op", F.when(F.col("n") > 0, "u").otherwise("d")), batch_id, unique=True)

    def read(self, spark: SparkSession) -> DataFrame:
        rows = self.sums.read(spark)
        return rows.select(
            "user_id", "dt", F.col("n").alias("payment_count"), F.when(F.col("amounts") > 0, F.col("amount")).alias("payment_amount"),
            F.col("shops").alias("shop_count"), F.col("first").alias("first_payment_time"), F.col("last").alias("last_payment_time"))


class Dashboard:
    """A4 on a stream: amount, orders and customers of the day.

    The one global group is kept as a row per shard of the users and a counted set of customers, so
    no row is hot; readers add the shards. Each day has tables of its own: at midnight the next
    batch begins new ones and the day before is no longer read.
    """

    def __init__(self, root: str, shards: int = SHARDS) -> None:
        self.root, self.shards = root.rstrip("/"), shards

    def _tables(self, day: str) -> tuple[UpsertTable, CountedSet]:
        totals = UpsertTable(f"{self.root}/{day}/totals", ["shard"])
        return totals, CountedSet(f"{self.root}/{day}/customers", ["shard"], "user_id", self.shards, ["user_id"])

    def step(self, deltas: DataFrame, batch_id: int, day: str, keep: Keep) -> None:
        """Take in the signed rows of the day; rows of other days are not on the dashboard."""
        spark = deltas.sparkSession
        totals, customers = self._tables(day)
        shard = F.pmod(F.xxhash64("user_id"), F.lit(self.shards)).cast("int")
        rows = deltas.filter(F.col("dt") == day).withColumn("shard", shard)
        changed = customers.step(rows, batch_id, customers.table.touched(rows), keep)
        sign, zero = F.col(SIGN).cast("bigint"), F.lit(0).cast("bigint")
        amounts = F.when(F.col("pay_amount").isNotNull(), sign).otherwise(0).cast("bigint")
        parts = rows.select(
            "shard", sign.alias("orders"), amounts.alias("amounts"),
            F.coalesce(F.col("pay_amount").cast(MONEY) * sign, F.lit(0)).cast(MONEY).alias("amount"), zero.alias("customers"))
        parts = parts.unionByName(changed.select(
            "shard", zero.alias("orders"), zero.alias("amounts"), F.lit(0).cast(MONEY).alias("amount"), F.col("change").cast("bigint").alias("customers")))
        if totals.written(spark, batch_id):
            parts = parts.unionByName(totals.read(spark, batch_id))
        totals.append(parts.groupBy("shard").agg(
            *[F.sum(c).alias(c) for c in ("orders", "amounts", "customers")], F.sum("amount").cast(MONEY).alias("amount")), batch_id, unique=True)

    def read(self, spark: SparkSession, day: str) -> DataFrame:
        """Metrics of a day as key and text value; without payments there is no amount row."""
        totals, _ = self._tables(day)
        empty = "shard int, orders bigint, amounts bigint, customers bigint, amount decimal(20,2)"
        rows = totals.read(spark) if totals.written(spark) else spark.createDataFrame([], empty)
        summed = rows.agg(
            F.when(F.sum("amounts") > 0, F.sum("amount").cast(MONEY).cast("string")).alias("gmv"),
            F.coalesce(F.sum("orders"), F.lit(0)).cast("string").alias("orders"),
            F.coalesce(F.sum("customers"), F.lit(0)).cast("string").alias("customers"))
        return summed.selectExpr(
            "stack(3, 'today_gmv', gmv, 'today_order_count', orders, 'today_customer_count', customers) AS (metric_key, metric_value)"
        ).filter("metric_value IS NOT NULL")


class PaymentJob:
    """The chain on one stream: facts, then their consumers, on the same signed rows."""

    def __init__(
        self, root: str, sums: bool = True, today: Callable[[DataFrame, int], str] | None = None, buckets: int = BUCKETS
    ) -> None:
        self.fact = PaymentFact(f"{root}/fact", buckets)
        self.sums = PaymentSums(f"{root}/sums", buckets) if sums else None
        self.dashboard = Dashboard(f"{root}/dashboard", buckets) if today else None
        self.today = today

    def step(self, batch: DataFrame, batch_id: int) -> None:
        with kept() as keep:
            deltas = self.fact.step(batch, batch_id, keep)
            if self.sums:
                self.sums.step(deltas, batch_id, keep)
            if self.dashboard:
                self.dashboard.step(deltas, batch_id, self.today(batch, batch_id), keep)

    def stream(self, feed: DataFrame, checkpoint: str) -> DataStreamWriter:
        return batch_job(feed, checkpoint, self.step)
