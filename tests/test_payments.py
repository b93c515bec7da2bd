"""Payments on a stream against plain replays, and the bucketed keyed tables they use."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.session import stream_session
from tidemart.sinks.upsert import UpsertTable
from tidemart.streaming.payments import FEED, PaymentJob, kept

DAY = datetime(2024, 1, 15)


def changes(seed):
    """Versioned, deleted, moved, repeated and late changes, some with null fields, in three batches."""
    rng, out = random.Random(seed), []
    pos = 0
    for _ in range(3):
        batch = []
        for _ in range(60):
            pos += 1
            at = pos if rng.random() > 0.1 else max(pos - 40, 0) + 0.5  # an older version that comes late
            if rng.random() < 0.65:
                time = None if rng.random() < 0.05 else DAY + timedelta(hours=12 * rng.randint(0, 3), minutes=rng.randint(0, 2))
                row = (
                    f"p{rng.randint(0, 14)}", rng.choice(["o1", "o2", "o3", "o4", None]), time,
                    None if rng.random() < 0.1 else Decimal(rng.randint(100, 900)) / 100, "card",
                    rng.choice(["success", "success", "success", "pending"]), rng.choice(["u1", "u2", None]))
                batch.append(("payment", "d" if rng.random() < 0.2 else "u", int(at * 2), row, None))
            else:
                row = (rng.choice(["o1", "o2", "o3", "o4"]), DAY, "book", "g", rng.choice(["s1", "s2", None]))
                batch.append(("order", "d" if rng.random() < 0.15 else "u", int(at * 2), None, row))
        out.append(batch + batch[:5])
    return out


def replay(batches):
    """The fact after all changes."""
    pays, orders = {}, {}
    for batch in batches:
        for kind, op, pos, pay, order in batch:
            state, row = (pays, pay) if kind == "payment" else (orders, order)
            if row[0] not in state or state[row[0]][0] <= pos:
                state[row[0]] = (pos, op, row)
    goods = {k: r for k, (_, op, r) in orders.items() if op != "d"}
    fact = []
    for _, op, (pay, order, time, amount, _, status, user) in pays.values():
        if op != "d" and status == "success":
            shop = goods[order][4] if order in goods else None
            fact.append((pay, order, user, time, amount, shop, time and time.strftime("%Y-%m-%d")))
    return fact


def sums(fact):
    groups = {}
    for _, _, user, time, amount, shop, dt in fact:
        groups.setdefault((user, dt), []).append((time, amount, shop))
    out = []
    for key, rows in groups.items():
        times = [t for t, _, _ in rows if t]
        amounts = [a for _, a, _ in rows if a is not None]
        out.append((*key, len(rows), sum(amounts) if amounts else None, len({s for *_, s in rows if s}),
                    min(times, default=None), max(times, default=None)))
    return sorted(out, key=repr)


def test_batches_retract_and_repeat(spark, tmp_path):
    child, batches, day = stream_session(spark), changes(4), "2024-01-15"
    job = PaymentJob(str(tmp_path), today=lambda batch, batch_id: day, buckets=3)
    for number, batch in enumerate(batches):
        frame = child.createDataFrame(batch, FEED).repartition(3)
        job.step(frame, number)
        if number == 1:
            job.step(frame, number)  # again, as after a failure
        fact = replay(batches[:number + 1])
        got = [tuple(r) for r in job.fact.read(child).select("pay_id", "order_id", "user_id", "pay_time", "pay_amount", "shop_id", "dt").collect()]
        assert sorted(got, key=repr) == sorted(fact, key=repr)
        assert sorted((tuple(r) for r in job.sums.read(child).collect()), key=repr) == sums(fact)
        of_day = [f for f in fact if f[6] == day]
        amounts = [f[4] for f in of_day if f[4] is not None]
        metrics = {r.metric_key: r.metric_value for r in job.dashboard.read(child, day).collect()}
        assert metrics == {
            **({"today_gmv": str(sum(amounts))} if amounts else {}), "today_order_count": str(len(of_day)),
            "today_customer_count": str(len({f[2] for f in of_day if f[2]}))}
    assert {r.metric_key: r.metric_value for r in job.dashboard.read(child, "2024-01-20").collect()} == {
        "today_order_count": "0", "today_customer_count": "0"}


def buckets_of(df):
    return {f.rsplit("_bucket=", 1)[1].split("/")[0] for f in df.inputFiles()}


def test_reads_open_the_buckets_they_need(spark, tmp_path):
    table = UpsertTable(f"{tmp_path}/t", ["k"], buckets=8)
    table.append(spark.range(200).select(F.col("id").alias("k"), F.lit("u").alias("op"), F.lit(1).alias("v")), 0)
    table.append(spark.range(5).select(F.col("id").alias("k"), F.lit("u").alias("op"), F.lit(2).alias("v")), 1)
    assert len(buckets_of(table.read(spark))) == 8
    near = table.touched(spark.createDataFrame([(3,)], "k long"))
    some = table.read(spark, near=near)
    assert len(near) == 1 and buckets_of(some) == {str(near[0])}
    assert {r.k: r.v for r in some.collect()} == {k: (2 if k < 5 else 1) for k in range(200) if table.touched(spark.createDataFrame([(k,)], "k long")) == near}
    one = table.get(spark, 3)
    assert buckets_of(one) == {str(near[0])} and [r.v for r in one.collect()] == [2]
    assert table.get(spark, 900).collect() == [] and table.read(spark, near=[]).collect() == []
    table.append(spark.range(5).select(F.col("id").alias("k"), F.lit("d").alias("op"), F.lit(2).alias("v")), 2)
    assert table.get(spark, 3).collect() == [] and table.read(spark).count() == 195


def test_expired_folders_go_after_the_retention(spark, tmp_path):
    table = UpsertTable(f"{tmp_path}/t", ["k"], buckets=2)
    for batch in range(3):
        table.append(spark.range(10).select(F.col("id").alias("k"), F.lit("u").alias("op"), F.lit(batch).alias("v")), batch)
    assert table.expire(spark, 0) == []
    table.compact(spark)
    assert table.expire(spark, 3600) == []
    assert len(table.expire(spark, -5)) == 3
    assert {r.v for r in table.read(spark).collect()} == {2} and table.read(spark).count() == 10


def test_frames_are_let_go(spark):
    with kept() as keep:
        df = keep(spark.range(3))
        assert df.is_cached
    assert not df.is_cached


def test_one_folder_is_read_without_a_merge(spark, tmp_path):
    table = UpsertTable(f"{tmp_path}/t", ["k"], buckets=2)
    rows = spark.range(10).select(F.col("id").alias("k"), F.lit("u").alias("op"), F.lit(1).alias("v"))
    table.append(rows, 0)
    assert "Window" not in table.read(spark)._jdf.queryExecution().optimizedPlan().toString()
    table.append(rows.withColumn("v", F.lit(2)), 1)
    assert "Window" in table.read(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert {r.v for r in table.read(spark).collect()} == {2}
