"""Facts kept current on a stream of changes: only the orders a micro-batch touches are joined again."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators import joins
from tidemart.operators.latest import latest_per_key
from tidemart.plans.dwd import CHANGE_ORDER
from tidemart.schemas import FACT_TABLES
from tidemart.session import folder_bytes, remove_folder
from tidemart.sinks.upsert import UpsertTable
from tidemart.streaming.payments import BUCKETS

States = Mapping[str, DataFrame]
Lay = Callable[[DataFrame, str], DataFrame]

#: Orders of a micro-batch are joined again in rounds, each of some buckets, whose states take about so much on disk.
ROUND_BYTES = 128 << 20


@contextmanager
def laid(spark: SparkSession, folder: str) -> Iterator[Lay]:
    """Frames that a step uses more than once are written once below a folder, which is removed at its end.

    Unlike cached frames they hold no memory of the executors, and what was shuffled for them goes as soon as they are written.
    """

    def lay(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    try:
        yield lay
    finally:
        remove_folder(spark, folder)


class TouchedFact:
    """A fact over captured tables, with the tables' states and the fact in keyed tables.

    ``tables`` names each captured table's order column, ``compute`` is the batch join of
    the states. A micro-batch updates the states, takes the orders of its changes,
    computes those orders alone and writes the rows that are not as they were; rows that are no longer there are
    deleted. States and fact lie in buckets of the order, so a batch opens those of its
    orders and no others, and joins them in rounds of some buckets if they are large. A row that moves to another order is deleted at the old one,
    which ``placed``, bucketed by row, remembers. All writes are by batch number, so a
    batch run again changes nothing. The change records are read once and never cached: only the columns the
    states need are laid aside while the batch runs.
    """

    def __init__(
        self, root: str, tables: Mapping[str, str], compute: Callable[[States], DataFrame], key: str = "id",
        buckets: int = BUCKETS,
    ) -> None:
        self.root, self.tables, self.compute, self.key = root.rstrip("/"), dict(tables), compute, key
        self.states = {
            t: UpsertTable(f"{root}/{t}", list(dict.fromkeys(["id", order])), CHANGE_ORDER, buckets=buckets, bucket_by=[order])
            for t, order in tables.items()}
        self.placed = {
            t: UpsertTable(f"{root}/placed/{t}", ["id"], CHANGE_ORDER, op="_none", buckets=buckets)
            for t, order in tables.items() if order != "id"}
        self.fact = UpsertTable(f"{root}/fact", [key, "order_id"], buckets=buckets, bucket_by=["order_id"])

    def _images(self, batch: DataFrame) -> DataFrame:
        """Row images of the captured tables in one pass over the records, each in its table's column."""
        table = F.col("source")["table"]
        records = batch.filter(table.isin(*self.tables)).withColumn("_table", table)
        text = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        place = F.try_element_at("source", F.lit("pos")).try_cast("bigint").alias("pos")
        images = [F.when(F.col("_table") == t, F.from_json(text, FACT_TABLES[t])).alias(t) for t in self.tables]
        return records.select("_table", *images, "op", "ts_ms", place)

    def _settle(self, table: str, changes: DataFrame, batch_id: int, lay: Lay) -> None:
        """Take the latest change of each row into a table's state, with deletes where it moved to another order."""
        state, latest = self.states[table], latest_per_key(changes, ["id"], CHANGE_ORDER)
        if table not in self.placed:
            state.append(latest, batch_id, unique=True)
            return
        # Only what the fact needs is kept, and only rows that moved are looked at again: most do not.
        latest, placed, order = lay(latest, "latest"), self.placed[table], self.tables[table]
        places = latest.select("id", order, *CHANGE_ORDER)
        known = None
        if placed.written(changes.sparkSession, batch_id):
            known = placed.read(changes.sparkSession, batch_id, placed.touched(latest))
        placed.append(places, batch_id, unique=True)
        if known is not None:
            was = known.select(
                F.col("id").alias("_id"), F.col(order).alias("_was"), F.struct(*CHANGE_ORDER).alias("_place"))
            moved = places.join(was, F.col("id").eqNullSafe(F.col("_id"))).filter(~F.col(order).eqNullSafe(F.col("_was")))
            moved = lay(moved.withColumn("_late", F.struct(*CHANGE_ORDER) < F.col("_place")), "moved")
            if not moved.isEmpty():
                late = moved.filter("_late").select("_id")
                gone = moved.filter("NOT _late").withColumns({order: F.col("_was"), "op": F.lit("d")})
                stays = latest.join(late, F.col("id").eqNullSafe(F.col("_id")), "left_anti")
                latest = stays.unionByName(gone.select("id", *dict.fromkeys([order, *CHANGE_ORDER, "op"])), allowMissingColumns=True)
        state.append(latest, batch_id, unique=True)

    def _rounds(self, spark: SparkSession, near: Sequence[int]) -> list[list[int]]:
        """The buckets of a micro-batch in groups; a bucket is the least."""
        if not near:
            return [[]]
        size = sum(folder_bytes(spark, state.path) for state in self.states.values()) * len(near) // self.fact.buckets
        rounds = min(len(near), max(1, -(-size // ROUND_BYTES)))
        return [sorted(near)[n::rounds] for n in range(rounds)]

    def _changed(self, spark: SparkSession, touched: DataFrame, near: Sequence[int], batch_id: int) -> DataFrame:
        """Rows of the fact of the touched orders in some buckets that are not as they were, and deletes."""
        here = touched.filter(self.fact.bucket(["order_id"]).isin(*near)) if near else touched

        def of_orders(table: UpsertTable, order: str, before: int) -> DataFrame:
            return table.read(spark, before, near, here.select(F.col("order_id").alias(order)))

        current = {
            table: of_orders(state, self.tables[table], batch_id + 1).drop(*CHANGE_ORDER) for table, state in self.states.items()}
        rows = latest_per_key(self.compute(current), self.fact.keys, [self.key])
        if not self.fact.written(spark, batch_id):
            return rows.withColumn("op", F.lit("u"))
        names = rows.columns
        new = rows.select(F.struct(*names).alias("_new"))
        old = of_orders(self.fact, "order_id", batch_id).select(F.struct(*names).alias("_old"))
        same = F.col(f"_old.{self.key}").eqNullSafe(F.col(f"_new.{self.key}")) & (F.col("_old.order_id") == F.col("_new.order_id"))
        gone = F.col("_new").isNull()
        rows = old.join(new, same, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
        return rows.select(
            *[(F.when(gone, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")) if c in self.fact.keys else F.col(f"_new.{c}")).alias(c)
              for c in names], F.when(gone, "d").otherwise("u").alias("op"))

    def step(self, batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{self.root}/laid/{batch_id}"
        with laid(spark, f"{folder}/changes") as lay:
            changes = lay(self._images(batch), "all")
            for table in self.tables:
                with laid(spark, f"{folder}/{table}") as lay_table:
                    images = changes.filter(F.col("_table") == table).select(f"{table}.*", "op", *CHANGE_ORDER)
                    self._settle(table, images, batch_id, lay_table)
        with laid(spark, f"{folder}/fact") as lay:
            orders = [
                self.states[table].batch(spark, batch_id).select(F.col(order).alias("order_id")) for table, order in self.tables.items()]
            touched = lay(reduce(DataFrame.union, orders).filter("order_id IS NOT NULL").distinct(), "touched")
            rounds = self._rounds(spark, self.fact.touched(touched))
            rows = [self._changed(spark, touched, near, batch_id) for near in rounds]
            if len(rows) > 1:  # each round's shuffles go before the next one begins
                rows = [lay(part, f"rows{n}") for n, part in enumerate(rows)]
            self.fact.append(reduce(DataFrame.union, rows), batch_id, unique=True)
        remove_folder(spark, folder)

    def stream(self, cdc: DataFrame, checkpoint: str, first: int = 0) -> DataStreamWriter:
        """``first`` is the number of the first micro-batch, for a log that goes on under a new checkpoint."""
        step = lambda batch, batch_id: self.step(batch, first + batch_id)
        return cdc.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)


WIDE = {"order_detail": "order_id", "order_info": "id", "order_detail_activity": "order_id", "order_detail_coupon": "order_id"}


def _wide(widen: Callable[..., DataFrame]) -> Callable[[States], DataFrame]:
    # Lines of the touched orders lie by their order already.
    return lambda s: widen(*[s[t] for t in WIDE], join=joins.plain_join)


def order_detail(root: str, buckets: int = BUCKETS) -> TouchedFact:
    """J3 on a stream."""
    return TouchedFact(root, WIDE, _wide(joins.order_detail_wide), buckets=buckets)


def order_cancel(root: str, buckets: int = BUCKETS) -> TouchedFact:
    """J1 on a stream."""
    return TouchedFact(root, WIDE, _wide(joins.cancelled_lines), buckets=buckets)


def order_refund(root: str, dic: Callable[[], DataFrame], buckets: int = BUCKETS) -> TouchedFact:
    """Refund requests on a stream; the dictionary is read anew for every micro-batch."""
    return TouchedFact(
        root, {"order_refund_info": "order_id", "order_info": "id"},
        lambda s: joins.order_refund(s["order_refund_info"], s["order_info"], dic()), buckets=buckets)


def refund_pay(root: str, dic: Callable[[], DataFrame], buckets: int = BUCKETS) -> TouchedFact:
    """J4 on a stream."""

    def compute(s: States) -> DataFrame:
        paid = joins.refund_pay(s["refund_payment"], s["order_refund_info"], s["order_info"], dic())
        return latest_per_key(paid, ["id"], ["ts", "refund_num"])

    return TouchedFact(root, {"refund_payment": "order_id", "order_refund_info": "order_id", "order_info": "id"}, compute, buckets=buckets)


def payment_success(root: str, dic: Callable[[], DataFrame], buckets: int = BUCKETS) -> TouchedFact:
    """J5 on a stream, with the lines' order, activity and coupon."""

    def compute(s: States) -> DataFrame:
        lines = joins.paid_lines(s["payment_info"], s["order_detail"])
        wide = joins.order_detail_wide(
            lines, s["order_info"], s["order_detail_activity"], s["order_detail_coupon"], keep=joins.PAID,
            join=joins.plain_join)
        return latest_per_key(joins.paid_columns(wide, dic()), ["order_detail_id"], ["ts", "callback_time"])

    return TouchedFact(root, {**WIDE, "payment_info": "order_id"}, compute, key="order_detail_id", buckets=buckets)
