"""Served metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators import aggregates
from tidemart.operators.projections import filter_day


def customer_analysis(visit: DataFrame, pay: DataFrame, stamped: bool = False) -> DataFrame:
    out = aggregates.customer_analysis(visit, pay)
    return out.withColumn("update_time", F.current_timestamp()) if stamped else out


def realtime_dashboard(fact: DataFrame, day: str | None = None, stamped: bool = False) -> DataFrame:
    """A4 from the payment fact: one row per payment."""
    of_day = filter_day(fact.select("pay_time", "pay_amount", "user_id", "dt"), day, time="pay_time")
    out = aggregates.dashboard(of_day)
    return out.withColumn("update_time", F.current_timestamp()) if stamped else out
