"""What must hold beyond the sizes that the tables have."""

import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.functions import text
from tidemart.operators import dedup, projections
from tidemart.plans import ads
from tidemart.session import stream_session
from tidemart.sinks.upsert import write_upsert
from tidemart.streaming import jobs, stateful


def test_bloom_grows_beyond_its_design():
    random = np.random.default_rng(0)
    keys = random.integers(0, 1 << 62, (50_000, 2))
    bloom, kept = dedup.GrowingBloom(1000, 0.01), 0
    for at in range(0, len(keys), 7000):
        kept += bloom.keep(keys[at:at + 7000, 0], keys[at:at + 7000, 1]).sum()
        bloom = dedup.GrowingBloom.unpacked(bloom.packed())
    assert kept >= 0.99 * len(keys) and len(bloom.layers) > 4
    assert not bloom.keep(keys[:, 0], keys[:, 1]).any()


def test_bloom_batch_keeps_nearly_all(spark):
    rows = spark.range(50_000).selectExpr("id AS order_id", "id % 7 AS ts_ms")
    kept = dedup.dedup_bloom(rows.unionByName(rows), expected=500, rate=0.01, approximate=True, shards=2)
    assert 0.99 * 50_000 <= kept.count() == kept.distinct().count()


@pytest.mark.parametrize(("value", "allowed"), [("a(b)", True), ("（）)", True), ("a b", False), ("ab\n", False), ("", False), ("价格￥5……", True)])
def test_allowed_characters_of_whole_texts(spark, value, allowed):
    row = spark.createDataFrame([(value,)], "t string").select(text.only_allowed_characters(F.col("t"))).first()
    assert row[0] is allowed


def test_upserts_without_a_number_follow_one_another(spark, tmp_path):
    schema = "id int, ts int, op string, v string"
    write_upsert(spark.createDataFrame([(1, 1, "c", "a"), (2, 1, "c", "b")], schema), f"{tmp_path}/t", ["id"], ["ts"])
    table = write_upsert(spark.createDataFrame([(3, 1, "c", "c")], schema), f"{tmp_path}/t", ["id"], ["ts"])
    assert sorted(r.id for r in table.read(spark).collect()) == [1, 2, 3]


LOG = "n int, mid string, is_new string, ts long"
DAY = 86_400_000


def test_first_visit_skips_records_without_a_time(spark):
    rows = [(1, "a", "1", None), (2, "a", "1", DAY), (3, "a", "1", 2 * DAY), (4, "a", "0", None)]
    fixed = dedup.fix_is_new(spark.createDataFrame(rows, LOG), "n").collect()
    assert {r.n: r.is_new for r in fixed} == {1: "1", 2: "1", 3: "0", 4: "0"}


def test_first_visit_stream_skips_them_too(spark, tmp_path):
    child = stream_session(spark)
    rows = [(1, "a", "1", None), (2, "a", "1", DAY), (3, "a", "1", 2 * DAY), (4, "a", "0", None), (5, "b", "1", None)]
    child.createDataFrame(rows, LOG).coalesce(1).write.json(f"{tmp_path}/in")
    source = child.readStream.schema(LOG).json(f"{tmp_path}/in")
    out = stateful.fix_is_new_stream(source, "n")
    jobs.finish(out.writeStream.option("checkpointLocation", f"{tmp_path}/c").format("parquet").option("path", f"{tmp_path}/out"))
    found = {r.n: r.is_new for r in child.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {1: "1", 2: "1", 3: "0", 4: "0", 5: "1"}


def test_first_visits_in_a_table(spark, tmp_path):
    """Batches in order, a repeated batch, records without time or device, and an entry that expires."""
    visits = stateful.FirstVisits(f"{tmp_path}/v", ttl_ms=3_600_000)
    batches = [
        [(1, "a", "1", None), (2, "a", "1", DAY), (3, None, "1", DAY)],
        [(4, "a", "1", DAY), (5, "a", "1", 2 * DAY), (6, "b", "0", 5 * DAY), (7, "b", "1", 5 * DAY)],
    ]
    for number, rows in [*enumerate(batches), (1, batches[1])]:
        out = {r.n: r.is_new for r in visits.repair(spark.createDataFrame(rows, LOG), number, "n").collect()}
        assert out == [{1: "1", 2: "1", 3: "1"}, {4: "1", 5: "0", 6: "0", 7: "0"}][number]
    expired = stateful.FirstVisits(f"{tmp_path}/v", ttl_ms=1)
    again = expired.repair(spark.createDataFrame([(8, "a", "1", 9 * DAY)], LOG), 2, "n").collect()
    assert [r.is_new for r in again] == ["1"]


def test_first_visits_are_found_from_the_marks_alone(spark, tmp_path):
    """A batch that is costly to compute is computed for the result only."""
    seen = spark.sparkContext.accumulator(0)
    visits, marks = stateful.FirstVisits(f"{tmp_path}/v"), spark.createDataFrame([(1, "a", "1", DAY), (2, "a", "1", 2 * DAY)], LOG)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    out = visits.repair(marks.mapInArrow(counted, LOG), 0, "n", marks=marks)
    assert seen.value == 0
    assert {r.n: r.is_new for r in out.collect()} == {1: "1", 2: "0"} and seen.value == 2


class FakeState:
    """The part of a group state that the expiry rule uses, with a clock."""

    def __init__(self):
        self.exists, self.get, self.now, self.timeout, self.hasTimedOut = False, None, 0, None, False

    def update(self, value):
        self.exists, self.get = True, value

    def getCurrentProcessingTimeMs(self):
        return self.now

    def setTimeoutDuration(self, ms):
        self.timeout = self.now + ms


def test_reading_does_not_renew_a_state():
    state = FakeState()
    seen = []

    def step(_key, batches, written):
        for value in batches:
            seen.append(written.value if written.exists else None)
            if not written.exists or value > written.value:
                written.write(value)
        return iter(())

    update = stateful._with_ttl(step, 1000)
    list(update(("k",), iter([5]), state))
    assert state.timeout == 1000
    state.now = 400
    list(update(("k",), iter([3]), state))  # nothing greater: the old time stays
    assert state.timeout == 1000
    state.now = 700
    list(update(("k",), iter([9]), state))
    assert state.timeout == 1700 and seen == [None, 5, 5]


def test_exact_dedup_remembers_all_batches(spark, tmp_path):
    step = stateful.dedup_exact_batches(str(tmp_path), ["a", "b"])
    batches = [[(1, None), (1, None), (2, "x")], [(2, "x"), (3, "y")], [(1, None), (3, "y"), (4, "z")]]
    for number, rows in enumerate([*batches, batches[2]]):  # the last batch again, after a failure
        step(spark.createDataFrame(rows, "a int, b string"), min(number, 2))
    found = sorted(r.a for r in stateful.dedup_exact_rows(spark, str(tmp_path)).collect())
    assert found == [1, 2, 3, 4]


def test_dashboard_reads_one_day_without_a_join(spark, tmp_path):
    when = datetime.datetime(2024, 1, 15, 12)
    rows = [(when, Decimal(5), "u", "2024-01-15"), (when - datetime.timedelta(days=1), Decimal(7), "v", "2024-01-14")]
    spark.createDataFrame(rows, "pay_time timestamp, pay_amount decimal(10,2), user_id string, dt string").write.parquet(f"{tmp_path}/fact")
    out = ads.realtime_dashboard(spark.read.parquet(f"{tmp_path}/fact"), "2024-01-15")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(pay_time" in plan and "LessThan(pay_time" in plan and "Join" not in plan
    assert dict(out.collect()) == {"today_gmv": "5.00", "today_order_count": "1", "today_customer_count": "1"}
    assert projections.filter_day(spark.read.parquet(f"{tmp_path}/fact"), time="pay_time").count() == 0
