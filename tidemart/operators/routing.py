"""Splitting and routing of raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.keys import md5_key
from tidemart.operators.latest import current_rows
from tidemart.operators.projections import cdc_image, once
from tidemart.schemas import CDC_TABLES

LOG_OUTPUTS = ("err", "start", "display", "action", "page")


def cdc_route(df: DataFrame, table: str) -> DataFrame:
    """Change records of one source table."""
    return df.filter(F.col("source")["table"] == table)


def clean_cdc(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Config changes without transport fields; deletes keep only before."""
    deleted = F.col("op") == "d"
    return df.select(
        "op",
        F.when(deleted, F.col("before")).alias("before"),
        F.when(~deleted, F.col("after")).alias("after"),
        *keep,
    )


def with_fields(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON object text as a map of top-level fields; null when it is no object."""
    return once(df, fields=F.expr(f"try_variant_get(try_parse_json({value}), '$', 'map<string,variant>')"))


def parse_json(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """P10: (records with a ``fields`` map, dirty rows as they came)."""
    parsed = with_fields(df, value)
    return parsed.filter("fields IS NOT NULL"), parsed.filter("fields IS NULL").drop("fields")


def log_keys(df: DataFrame) -> DataFrame:
    """Device id, new-visitor mark and time of parsed log records."""
    return once(
        df,
        mid=F.expr("try_variant_get(fields['common'], '$.mid', 'string')"),
        is_new=F.expr("try_variant_get(fields['common'], '$.is_new', 'string')"),
        ts=F.expr("try_variant_get(fields['ts'], '$', 'bigint')"),
    )


def put_is_new(df: DataFrame, is_new: str = "is_new") -> DataFrame:
    """Write a repaired new-visitor mark back into ``fields['common']``."""
    mark = F.col(is_new)
    changed = mark.isNotNull() & ~mark.eqNullSafe(
        F.expr("try_variant_get(fields['common'], '$.is_new', 'string')")
    )
    # The mark is text, so it is quoted as JSON before it rejoins the object; the
    # last parse puts the fields back in their usual order.
    text = f"""to_json(map_concat(
        map_filter(fields, (k, v) -> k <> 'common'),
        map('common', parse_json(to_json(map_concat(
          map_filter(try_variant_get(fields['common'], '$', 'map<string,variant>'), (k, v) -> k <> 'is_new'),
          map('is_new', variant_get(parse_json(to_json(map('v', {is_new}))), '$.v', 'variant'))))))))"""
    rebuilt = F.expr(f"variant_get(parse_json({text}), '$', 'map<string,variant>')")
    return df.withColumn("fields", F.when(changed, rebuilt).otherwise(F.col("fields")))


def _present(field: str) -> Column:
    return F.expr(f"fields['{field}'] IS NOT NULL AND NOT is_variant_null(fields['{field}'])")


def _elements(field: str) -> Column:
    return F.expr(f"try_variant_get(fields['{field}'], '$', 'array<variant>')")


def _err_text(keep_context: bool) -> Column:
    if not keep_context:
        return F.to_json(F.expr("fields['err']"))
    return F.to_json(F.struct(*[F.expr(f"fields['{f}']").alias(f) for f in ("common", "page", "err", "ts")]))


def _element_text(name: str, element: Column, with_ts: bool) -> Column:
    parts = [F.expr("fields['common']").alias("common"), F.expr("fields['page']").alias("page"), element.alias(name)]
    return F.to_json(F.struct(*parts, *([F.expr("fields['ts']").alias("ts")] if with_ts else [])))


def _start_text() -> Column:
    return F.to_json(F.expr("map_filter(fields, (k, v) -> k <> 'err' OR is_variant_null(v))"))


def _page_text() -> Column:
    # An empty array stays in the page record, a filled one has been sent on.
    return F.to_json(F.expr(
        """map_filter(fields, (k, v) -> NOT (
             (k = 'err' AND NOT is_variant_null(v))
             OR (k IN ('displays', 'actions') AND size(try_variant_get(v, '$', 'array<variant>')) > 0)))"""
    ))


def split_log(df: DataFrame, keep: tuple[str, ...] = (), keep_context: bool = False) -> dict[str, DataFrame]:
    """Five outputs of parsed log records, each a JSON ``value`` column.

    * err: only the err object, for records that have one;
    * start: the whole record without err, for records with a start object;
    * display / action: one row per array element, for records without start;
    * page: what is left of a record without start.

    Action rows carry no time and err rows no context unless ``keep_context``.
    Each output reads its input anew; ``split_rows`` gives all of them in one pass.
    """
    pages = df.filter(~_present("start"))

    def exploded(field: str, name: str, with_ts: bool) -> DataFrame:
        rows = pages.select(*keep, "fields", F.explode(_elements(field)).alias("item"))
        return rows.select(*keep, _element_text(name, F.col("item"), with_ts).alias("value"))

    return {
        "err": df.filter(_present("err")).select(*keep, _err_text(keep_context).alias("value")),
        "start": df.filter(_present("start")).select(*keep, _start_text().alias("value")),
        "display": exploded("displays", "display", True),
        "action": exploded("actions", "action", keep_context),
        "page": pages.select(*keep, _page_text().alias("value")),
    }


def split_rows(
    df: DataFrame, keep: tuple[str, ...] = (), keep_context: bool = False, value: str = "value"
) -> DataFrame:
    """P14 in one pass: rows of (``output``, ``value``), dirty input included.

    The input has a ``fields`` map, null for dirty records, and the raw text.
    """

    def row(output: str, text: Column) -> Column:
        return F.struct(F.lit(output).alias("output"), text.alias("value"))

    def rows(output: str, field: str, with_ts: bool) -> Column:
        each = F.transform(_elements(field), lambda e: row(output, _element_text(output, e, with_ts)))
        return F.coalesce(each, nothing)

    nothing = F.array().cast("array<struct<output:string,value:string>>")
    err = F.when(_present("err"), F.array(row("err", _err_text(keep_context)))).otherwise(nothing)
    rest = F.when(_present("start"), F.array(row("start", _start_text()))).otherwise(F.concat(
        rows("display", "displays", True), rows("action", "actions", keep_context),
        F.array(row("page", _page_text())),
    ))
    dirty = F.array(row("dirty", F.col(value)))
    outputs = F.when(F.col("fields").isNull(), dirty).otherwise(F.concat(err, rest))
    return df.select(*keep, F.inline(outputs))


def current_config(changes: DataFrame, order_by: tuple[str, ...] = ("ts_ms",)) -> DataFrame:
    """Routing config in force: per source table the latest, unless deleted."""
    rows = cdc_image(changes, CDC_TABLES["table_process_dim"])
    return current_rows(rows, ["source_table"], list(order_by)).drop("ts_ms")


#: Source tables up to which their names, rather than the join alone, tell the records to route.
NAMED_TABLES = 1000


def _configured(rows: DataFrame, config: DataFrame) -> DataFrame:
    """The rows whose ``source_table`` has a config, which the join with it would keep; all rows if it has very many tables."""
    names = [r[0] for r in config.select("source_table").distinct().limit(NAMED_TABLES + 1).collect()]
    return rows if len(names) > NAMED_TABLES else rows.filter(F.col("source_table").isin([n for n in names if n is not None]))


def route_dims(cdc: DataFrame, config: DataFrame, project: bool = False) -> DataFrame:
    """Dimension rows of configured tables: sink table, hashed row key, text fields.

    ``info`` holds every field of the row image; ``project`` narrows it to the
    configured columns. Deletes are skipped. The config has one row per source
    table; Spark broadcasts it while its size is below the broadcast limit. Records of
    tables without config leave before their row images are read or made.
    """
    rows = cdc.filter("op <> 'd'").select(F.col("source")["table"].alias("source_table"), "after", "ts_ms")
    rows = _configured(rows, config)
    joined = rows.join(config.select("source_table", "sink_table", "sink_row_key", "sink_columns"), "source_table")
    # Parsed after the join: records of tables without config are never parsed.
    joined = joined.withColumn("info", F.from_json("after", "map<string,string>"))
    info: Column = F.transform_values("info", lambda _, v: F.coalesce(v, F.lit("null")))
    if project:
        wanted = F.split("sink_columns", ",")
        info = F.map_filter(info, lambda k, _: F.array_contains(wanted, k))
    return joined.select(
        "sink_table",
        md5_key(F.try_element_at("info", F.col("sink_row_key"))).alias("rowkey"),
        info.alias("info"),
        "ts_ms",
    )


# -- routing as of a record's place in the log ---------------------------------------

CONFIG_TABLE = "table_process_dim"


def position(df: DataFrame) -> DataFrame:
    """``at``: the place of a change record in its log, by time and then by number; places compare in log order."""
    number = F.coalesce(F.try_element_at("source", F.lit("pos")).try_cast("bigint"), F.lit(0))
    return df.withColumn("at", F.struct(F.col("ts_ms"), number.alias("pos")))


def config_intervals(changes: DataFrame) -> DataFrame:
    """J11 as of: each config row with the places [``begins``, ``ends``) between which it was in force.

    ``changes`` are the config's change records with ``at``; a record that was delivered twice counts once. A
    delete ends the row before it and begins none.
    """
    schema = CDC_TABLES[CONFIG_TABLE]
    rows = changes.select(F.from_json(F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")), schema).alias("image"), "op", "at")
    rows = rows.select("image.*", "op", F.col("at").alias("begins")).dropDuplicates(["source_table", "begins"])
    following = F.lead("begins").over(Window.partitionBy("source_table").orderBy("begins"))
    return rows.withColumn("ends", following).filter("op <> 'd'").drop("op")


def sink_definitions(changes: DataFrame) -> DataFrame:
    """S15 in log order: (sink_table, at, creates) for every table that a config change drops or creates.

    A delete drops the old table; a new row creates one; any other change drops the old one, then creates the
    new one at the same place.
    """
    schema = CDC_TABLES[CONFIG_TABLE]
    old, new = F.from_json("before", schema)["sink_table"], F.from_json("after", schema)["sink_table"]
    fresh, deleted = F.col("op").isin("r", "c"), F.col("op") == "d"

    def step(name: Column, number: int, creates: bool) -> Column:
        place = F.struct(F.col("at.ts_ms").alias("ts_ms"), F.col("at.pos").alias("pos"), F.lit(number).alias("step"))
        return F.struct(name.alias("sink_table"), place.alias("at"), F.lit(creates).alias("creates"))

    drop, create = step(old, 0, False), step(new, 1, True)
    steps = F.when(deleted, F.array(drop)).when(fresh, F.array(create)).otherwise(F.array(drop, create))
    return changes.select(F.inline(steps)).filter("sink_table IS NOT NULL").dropDuplicates(["sink_table", "at"])


def sink_states(definitions: DataFrame) -> DataFrame:
    """(sink_table, dropped, exists): the place of a table's last drop, and whether it is there at the end."""
    return definitions.groupBy("sink_table").agg(
        F.max(F.when(~F.col("creates"), F.struct("at.ts_ms", "at.pos"))).alias("dropped"), F.max_by("creates", "at").alias("exists"))


def route_dims_as_of(cdc: DataFrame, intervals: DataFrame, states: DataFrame, project: bool = False) -> DataFrame:
    """P17 by the config in force at each record's own place; ``lives`` is false if the sink was dropped after it."""
    rows = cdc.filter("op <> 'd'").select(F.col("source")["table"].alias("source_table"), "after", "at")
    rules = intervals.select(F.col("source_table").alias("_source"), "sink_table", "sink_row_key", "sink_columns", "begins", "ends")
    inside = (F.col("at") >= F.col("begins")) & (F.col("ends").isNull() | (F.col("at") < F.col("ends")))
    joined = rows.join(rules, (F.col("source_table") == F.col("_source")) & inside)
    joined = joined.join(states.select(F.col("sink_table").alias("_sink"), "dropped"), F.col("sink_table") == F.col("_sink"), "left")
    joined = joined.withColumn("info", F.from_json("after", "map<string,string>"))
    info: Column = F.transform_values("info", lambda _, v: F.coalesce(v, F.lit("null")))
    if project:
        wanted = F.split("sink_columns", ",")
        info = F.map_filter(info, lambda k, _: F.array_contains(wanted, k))
    return joined.select(
        "source_table", "sink_table", md5_key(F.try_element_at("info", F.col("sink_row_key"))).alias("rowkey"), info.alias("info"),
        "at", (F.col("dropped").isNull() | (F.col("at") > F.col("dropped"))).alias("lives"))
