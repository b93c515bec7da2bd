"""Queries of data quality: word checks, deduplication, row keys, salt buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.checks.registry import check
from tidemart.functions import keys, text
from tidemart.inputs import derive
from tidemart.inputs.sql import query
from tidemart.operators import dedup, quality
from tidemart.sources.tables import load


@check("p15_flag_sensitive", query("""
    SELECT m.user_id, m.info_consignee AS consignee, m.ts_ms, m.ds, m.comment_txt AS msg,
      CASE WHEN w.word IS NOT NULL THEN 1 ELSE 0 END AS is_violation,
      CASE WHEN w.word IS NOT NULL THEN 'P0' ELSE '' END AS violation_grade,
      coalesce(w.word, '') AS violation_msg
    FROM messages m LEFT JOIN words w ON m.token = w.word"""))
def p15_flag_sensitive(spark, sf):
    conversations = load(spark, sf, "conversations")
    return quality.flag_sensitive(derive.comment_messages(conversations), derive.words(conversations))


@check("p16_words_exist", query("""
    SELECT DISTINCT m.token AS word, w.word IS NOT NULL AS "exists"
    FROM messages m LEFT JOIN words w ON m.token = w.word"""))
def p16_words_exist(spark, sf):
    conversations = load(spark, sf, "conversations")
    tokens = conversations.select(text.last_token(F.col("text")).alias("word")).distinct()
    return quality.words_exist(tokens, derive.words(conversations))


@check("t2_dedup_latest", """
    SELECT event_id, user_id, k FROM (
      SELECT event_id, user_id, k, max(k) OVER (PARTITION BY user_id ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM (SELECT event_id, user_id, cast(json_extract_string(props, '$.k') as int) AS k FROM events))
    WHERE seen IS NULL OR k > seen""")
def t2_dedup_latest(spark, sf):
    rows = load(spark, sf, "events").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return dedup.dedup_latest(rows, "user_id", "k", "event_id")


@check("t3_dedup_exact", """
    SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def t3_dedup_exact(spark, sf):
    rows = load(spark, sf, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return dedup.dedup_exact(rows)


_T4 = "SELECT DISTINCT l_orderkey AS order_id, epoch_ms(l_shipdate) AS ts_ms FROM lineitem"


@check("t4_dedup_by_order", _T4)
def t4_dedup_by_order(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.unix_millis("l_shipdate").alias("ts_ms"))
    return dedup.dedup_bloom(rows)


BLOOM_RATE = 0.001


def bloom_quality(kept, rows, rate: float = BLOOM_RATE):
    """Repeats among the kept rows, and whether the lost share is within three times the rate."""
    marked = rows.withColumn("_n", F.lit(0)).unionByName(kept.withColumn("_n", F.lit(1)))
    by_key = marked.groupBy(*kept.columns).agg(F.sum("_n").alias("_n"))
    return by_key.agg(
        F.sum(F.greatest(F.col("_n") - 1, F.lit(0))).alias("repeats"),
        (F.count_if(F.col("_n") == 0) <= 3 * rate * F.count(F.lit(1)) + 3).alias("within_rate"))


@check("t4_dedup_bloom", "SELECT cast(0 as bigint) AS repeats, true AS within_rate")
def t4_dedup_bloom(spark, sf):
    """Approximate form, with filters designed for far fewer keys than come: never a repeat, few new rows lost."""
    rows = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.unix_millis("l_shipdate").alias("ts_ms"))
    shards = spark.sparkContext.defaultParallelism
    kept = dedup.dedup_bloom(rows, expected=1000, rate=BLOOM_RATE, approximate=True, shards=shards)
    return bloom_quality(kept, rows)


@check("f12_rowkey", """
    SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS sku_id,
      concat_ws('_', l_orderkey, md5(cast(l_linenumber as varchar)), l_partkey) AS mixed_key,
      md5(concat_ws('', l_orderkey, l_linenumber)) AS hashed_key FROM lineitem""")
def f12_rowkey(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("sku_id"))
    return rows.withColumns({
        "mixed_key": keys.rowkey(["order_id", "line", "sku_id"], "_", ["line"]),
        "hashed_key": keys.rowkey(["order_id", "line"], hash_all=True),
    })


@check("f13_salt_bucket", """
    SELECT bucket, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM (
      SELECT o_custkey, CASE WHEN o_custkey = 7 THEN '9001'
        ELSE lpad(cast(cast('0x' || right(md5(cast(o_custkey as varchar)), 3) as int) % 128 as varchar), 4, '0')
        END AS bucket FROM orders)
    GROUP BY bucket""")
def f13_salt_bucket(spark, sf):
    orders = load(spark, sf, "orders")
    bucket = keys.salt_bucket(F.col("o_custkey"), hot={"7": "9001"})
    return orders.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


_ALLOWED_SQL = """'[\\x{4e00}-\\x{9fa5}a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)"]+'"""


@check("f18_allowed_characters", f"""
    SELECT conv_id, turn, regexp_full_match(text, {_ALLOWED_SQL}) AS allowed,
      regexp_full_match('(' || regexp_replace(text, '[\\s,.]', '', 'g') || ')', {_ALLOWED_SQL}) AS packed_allowed
    FROM conversations""")
def f18_allowed_characters(spark, sf):
    """Whole texts, and whole texts in brackets without white space, commas and stops."""
    rows = load(spark, sf, "conversations")
    packed = F.concat(F.lit("("), F.regexp_replace("text", r"[\s,.]", ""), F.lit(")"))
    return rows.select(
        "conv_id", "turn", text.only_allowed_characters(F.col("text")).alias("allowed"),
        text.only_allowed_characters(packed).alias("packed_allowed"))
