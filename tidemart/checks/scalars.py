"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.checks.registry import check
from tidemart.functions import jsonio, text, times
from tidemart.sources.tables import load

_MS = "(epoch_us(ts) // 1000)"
_K = "cast(json_extract_string(props, '$.k') as int)"


@check("f1_f8_times", f"""
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS event_time,
      cast(epoch(date_trunc('day', ts)) as bigint) AS date_id, strftime(ts, '%Y-%m-%d') AS day,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_text, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
      CASE WHEN event_type = 'view' THEN ({_MS} // 1000) * 1000 ELSE {_MS} END AS millis
    FROM events""")
def f1_f8_times(spark, sf):
    ms = F.unix_millis("ts")
    raw = F.when(F.col("event_type") == "view", F.call_function("div", ms, F.lit(1000))).otherwise(ms)
    return load(spark, sf, "events").select(
        "event_id", times.event_time(ms).alias("event_time"), times.date_id(ms).alias("date_id"),
        times.day_text(F.col("ts")).alias("day"), times.millis_text(ms).alias("full_text"),
        times.previous_day(ms).alias("day_before"), times.to_millis(raw).alias("millis"),
    )


@check("f7_day_range", """
    SELECT o_orderkey, cast(strftime(unnest(generate_series(cast(o_orderdate as date),
      cast(o_orderdate as date) + 2, INTERVAL 1 DAY)), '%Y%m%d') as int) AS day FROM orders""")
def f7_day_range(spark, sf):
    first = F.to_date("o_orderdate")
    return load(spark, sf, "orders").select(
        "o_orderkey", F.explode(times.day_range(first, F.date_add(first, 2))).alias("day"))


@check("f9_f14_json", f"""
    SELECT event_id, cast({_K} as bigint) AS k, CASE WHEN {_K} >= 50 THEN cast({_K} as bigint) ELSE 0 END AS ts_or_zero,
      cast({_K} as bigint) * 1000 AS first_ms, cast(cast(value as decimal(16,2)) as double) AS amount,
      '["a","' || {_K} || '"]' AS grown, '["' || {_K} || '"]' AS started
    FROM events""")
def f9_f14_json(spark, sf):
    props = F.col("props")
    k = jsonio.json_field(props, "k", "bigint")
    either = F.when(k >= 50, props).otherwise(F.lit("{bad"))
    return load(spark, sf, "events").select(
        "event_id", k.alias("k"), jsonio.json_ts(either, "k").alias("ts_or_zero"),
        jsonio.first_seconds(props, "block_timestamp", "k").alias("first_ms"),
        jsonio.amount(F.col("value").cast("decimal(16,2)").cast("string")).alias("amount"),
        jsonio.append_to_list(F.lit('["a"]'), k.cast("string")).alias("grown"),
        jsonio.append_to_list(F.lit(None).cast("string"), k.cast("string")).alias("started"),
    )


@check("f16_f20_text", """
    SELECT p_partkey, array_to_string([p_name, p_brand], '|') AS joined, array_to_string([p_name, p_type], ', ') AS csv,
      upper(p_name[1]) || substr(p_name, 2) AS upper_first, lower(p_type[1]) || substr(p_type, 2) AS lower_first,
      repeat('0', p_size) AS zeros, p_name = '' AS empty, trim(p_name) = '' AS blank,
      string_split(p_brand || ',' || p_type || ',,', ',')[2] AS last_token
    FROM part""")
def f16_f20_text(spark, sf):
    name, kind = F.col("p_name"), F.col("p_type")
    return load(spark, sf, "part").select(
        "p_partkey", text.join_list(F.array("p_name", "p_brand"), "|").alias("joined"),
        text.to_csv(F.array("p_name", "p_type")).alias("csv"), text.capitalise(name).alias("upper_first"),
        text.uncapitalise(kind).alias("lower_first"), text.zeros(F.col("p_size")).alias("zeros"),
        text.is_empty(name).alias("empty"), text.is_blank(name).alias("blank"),
        text.last_token(F.concat_ws(",", "p_brand", "p_type", F.lit(","))).alias("last_token"),
    )


@check("p6_safe_ratio", """
    SELECT user_id, CASE WHEN sum(b) > 0 THEN round(cast(sum(a) as double) / sum(b), 4) ELSE 0 END AS ratio
    FROM (SELECT user_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS a,
            CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS b FROM events)
    GROUP BY user_id""")
def p6_safe_ratio(spark, sf):
    def count(kind: str):
        return F.count(F.when(F.col("event_type") == kind, 1))

    ratio = jsonio.safe_ratio(count("purchase").cast("double"), count("view"))
    return load(spark, sf, "events").groupBy("user_id").agg(F.round(ratio, 4).alias("ratio"))
