"""Queries of the application log: parsing, visitor repair, splitting, page visitors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.checks.registry import check
from tidemart.inputs import derive
from tidemart.inputs.sql import query
from tidemart.operators.aggregates import page_uv
from tidemart.operators.dedup import fix_is_new
from tidemart.operators.routing import log_keys, parse_json, split_log
from tidemart.plans.applog import log_split, repaired
from tidemart.session import shared_dir
from tidemart.sources.tables import load


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return derive.app_log(load(spark, sf, "events"))


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    return log_keys(parse_json(_log(spark, sf))[0])


@check("p10_dirty_records", query("""
    SELECT log_id, '{bad ' || log_id AS value FROM log_parts WHERE dirty"""))
def p10_dirty_records(spark, sf):
    return parse_json(_log(spark, sf))[1]


@check("t1_fix_is_new", query("SELECT log_id, mid, ms AS ts, is_new FROM fixed_log"))
def t1_fix_is_new(spark, sf):
    return fix_is_new(_keys(spark, sf).select("log_id", "mid", "is_new", "ts"), "log_id")


_OBJECT = """'{{"common":' || common_j || ',"page":' || page_j || ',"{name}":' || {item} || {tail}"""
_DISPLAY = "'{{\"item\":' || (k + {i}) || ',\"pos\":' || {pos} || '}}'"
_ACTION = "'{{\"action_id\":\"{act}\",\"item\":' || k || '}}'"

SPLIT = query(f"""
    SELECT 'dirty' AS output, log_id, '{{bad ' || log_id AS value FROM log_parts WHERE dirty
    UNION ALL SELECT 'err', log_id, err_j FROM log_json WHERE err_j IS NOT NULL
    UNION ALL SELECT 'start', log_id, '{{"common":' || common_j || ',"displays":[{{"item":' || k || ',"pos":1}}],'
      || '"start":{{"ad_id":' || k || ',"entry":"icon"}},"ts":' || ms || '}}' FROM log_json WHERE kind = 'signup'
    UNION ALL SELECT 'display', log_id,
      {_OBJECT.format(name='display', item=_DISPLAY.format(i='i', pos='i + 1').replace('|| i + 1 ||', '|| (i + 1) ||'),
                      tail="',\"ts\":' || ms || '}'")}
      FROM log_json CROSS JOIN (VALUES (0), (1)) n(i) WHERE kind = 'view' AND k >= 10
    UNION ALL SELECT 'action', log_id,
      {_OBJECT.format(name='action', item=_ACTION.format(act='cart_add'), tail="'}'")}
      FROM log_json WHERE kind IN ('click', 'purchase')
    UNION ALL SELECT 'action', log_id, {_OBJECT.format(name='action', item=_ACTION.format(act='pay'), tail="'}'")}
      FROM log_json WHERE kind = 'purchase'
    UNION ALL SELECT 'page', log_id, '{{"common":' || common_j
      || CASE WHEN kind = 'view' AND k < 10 THEN ',"displays":[]' ELSE '' END
      || ',"page":' || page_j || ',"ts":' || ms || '}}' FROM log_json WHERE kind <> 'signup'""")


@check("log_split", SPLIT)
def one_pass_split(spark, sf):
    return log_split(_log(spark, sf), "log_id", keep=("log_id",))


@check("p14_split_log", SPLIT)
def p14_split_log(spark, sf):
    """Each output reads the records anew, so they are parsed and repaired once and written."""
    folder = shared_dir(spark, "split-log")
    repaired(_log(spark, sf), "log_id").write.parquet(folder)
    records = spark.read.parquet(folder)
    outputs = split_log(records.filter("fields IS NOT NULL"), ("log_id",))
    outputs["dirty"] = records.filter("fields IS NULL").select("log_id", "value")
    frames = [df.select(F.lit(name).alias("output"), "log_id", "value") for name, df in outputs.items()]
    return reduce(DataFrame.unionByName, frames)


@check("t9_page_uv", query("""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS stt, strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS edt,
      strftime(w, '%Y-%m-%d') AS cur_date,
      count(DISTINCT CASE WHEN page_id = 'home' THEN mid END) AS home_uv_ct,
      count(DISTINCT CASE WHEN page_id = 'good_detail' THEN mid END) AS good_detail_uv_ct,
      cast(epoch(w) as bigint) * 1000 AS ts
    FROM (SELECT *, date_trunc('hour', ts) AS w FROM log_parts
          WHERE NOT dirty AND page_id IN ('home', 'good_detail'))
    GROUP BY w"""))
def t9_page_uv(spark, sf):
    log = _keys(spark, sf).select(
        "mid", F.expr("try_variant_get(fields['page'], '$.page_id', 'string')").alias("page_id"),
        F.timestamp_millis("ts").alias("ts"),
    )
    return page_uv(log, "1 hour")
