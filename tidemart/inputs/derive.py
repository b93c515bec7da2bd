"""The warehouse's input tables, derived from the given tables.

Every function is a narrow projection or filter of one table unless noted, so a
derived table grows with its source. The SQL of the same definitions is in
``inputs.sql``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.keys import md5_key
from tidemart.operators.projections import once
from tidemart.schemas import CDC_TABLES
from tidemart.sources.tables import load

HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Code dictionary (fixed values of the fixture).
DICTIONARY = {
    "1003": "cancelled", "1005": "refunding", "1006": "refunded",
    "1101": "wallet", "1102": "card",
    "1201": "good", "1202": "fair",
    "1602": "paid",
}

# Routing config as it changed over time (fixed values of the fixture):
# op, source table, sink table, row key, columns, time.
CONFIG_CHANGES = [
    ("r", "sku_info", "dim_sku_info", "id", "id,sku_name,tm_id", 1),
    ("r", "cart_info", "dim_cart_old", "id", "id,sku_id", 1),
    ("u", "cart_info", "dim_cart", "id", "id,sku_id,sku_num", 2),
    ("c", "payment_info", "dim_payment", "order_id", "order_id,payment_type", 3),
    ("d", "payment_info", "dim_payment", "order_id", "order_id,payment_type", 4),
]


# Routing config that changes while records flow (fixed values of the fixture):
# op, source table, old sink, new sink, row key, time. The times lie between those of the records.
CART_STOP_MS, CART_AGAIN_MS, SKU_MOVE_MS = 1_704_844_800_000, 1_705_708_800_000, 1_700_000_000_500
MIDSTREAM_CONFIG = [
    ("r", "sku_info", "", "dim_sku_draft", "id", 1),
    ("c", "cart_info", "", "dim_cart", "id", 1),
    ("u", "sku_info", "dim_sku_draft", "dim_sku", "id", SKU_MOVE_MS),
    ("d", "cart_info", "dim_cart", "", "id", CART_STOP_MS),
    ("c", "cart_info", "", "dim_cart_late", "id", CART_AGAIN_MS),
]


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _money(name: str, precision: int = 16) -> Column:
    return F.col(name).cast(f"decimal({precision},2)")


def _with_k(events: DataFrame) -> DataFrame:
    """Events with the number inside their properties as ``k``."""
    return once(events, k=F.get_json_object("props", "$.k").cast("int"))


def _k() -> Column:
    return F.col("k")


def _values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """Literal rows as a local relation, whose size Spark knows."""
    text = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({names})")


# -- relational family, from events --------------------------------------------

def behavior_log(events: DataFrame) -> DataFrame:
    kind, user = F.col("event_type"), _text("user_id")
    visit = (
        F.when(kind == "signup", "new").when(kind == "view", "return")
        .when(kind == "click", "return_no_buy").when(kind == "purchase", "purchase").otherwise("other")
    )
    return _with_k(events).select(
        user.alias("user_id"), F.concat(F.lit("d_"), user).alias("device_id"), visit.alias("visit_type"),
        F.col("ts").alias("event_time"), F.concat(F.lit("/page/"), _k()).alias("page_url"),
        kind.alias("page_type"), (_k() >= 50).alias("is_follow_shop"), F.col("ts").alias("proc_time"),
    )


def trade_order(events: DataFrame) -> DataFrame:
    """Orders of most purchases; the rest have a payment without an order."""
    rows = _with_k(events).filter((F.col("event_type") == "purchase") & (_k() < 80))
    return rows.select(
        _text("event_id").alias("order_id"), _text("user_id").alias("user_id"), F.col("ts").alias("order_time"),
        _money("value", 10).alias("pay_amount"), F.lit(True).alias("is_paid"), F.lit("done").alias("order_status"),
        F.when(_k() >= 40, "book").otherwise("food").alias("goods_type"),
        F.concat(F.lit("g_"), _k()).alias("goods_id"),
        F.concat(F.lit("s_"), F.call_function("div", _k(), F.lit(10))).alias("shop_id"),
    )


def trade_payment(events: DataFrame) -> DataFrame:
    rows = _with_k(events.filter(F.col("event_type").isin("purchase", "click")))
    return rows.select(
        F.concat(F.lit("p_"), F.col("event_id")).alias("pay_id"), _text("event_id").alias("order_id"),
        F.col("ts").alias("pay_time"), _money("value", 10).alias("pay_amount"),
        F.when(_k() >= 50, "card").otherwise("wallet").alias("pay_method"),
        F.when(F.col("event_type") == "purchase", "success").otherwise("pending").alias("pay_status"),
        _text("user_id").alias("user_id"),
    )


def login_log(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id", F.concat(F.lit("d_"), F.col("user_id")).alias("device_id"), F.to_date("ts").alias("login_date")
    )


def goods_log(part: DataFrame) -> DataFrame:
    return part.select(
        _text("p_partkey").alias("id"), F.concat(F.lit("g_"), F.col("p_partkey")).alias("goods_id"),
        F.col("p_type").alias("operate_type"), F.lit("2024-01-01 00:00:00").alias("operate_time"),
        _money("p_retailprice").cast("string").alias("price"), _text("p_size").alias("stock_num"),
        F.col("p_name").alias("operate_content"),
    )


def shop_log(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        _text("s_suppkey").alias("id"), F.col("s_name").alias("shop_id"),
        F.when(F.col("s_acctbal") >= 0, "open").otherwise("close").alias("operate_type"),
        F.lit("2024-01-01 00:00:00").alias("operate_time"), F.lit("status").alias("operate_content"),
        _text("s_nationkey").alias("operator_id"),
    )


def register_log(customer: DataFrame) -> DataFrame:
    return customer.select(
        _text("c_custkey").alias("user_id"), F.lit("2024-01-01 00:00:00").alias("register_time"),
        F.col("c_mktsegment").alias("register_channel"), F.concat(F.lit("d_"), F.col("c_custkey")).alias("device_id"),
        F.concat(F.lit("10.0.0."), F.col("c_nationkey")).alias("register_ip"),
    )


def activity_log(lineitem: DataFrame) -> DataFrame:
    day = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return lineitem.select(
        F.col("l_orderkey").cast("int").alias("id"), _text("l_linenumber").alias("activity_id"),
        _text("l_suppkey").alias("user_id"), F.col("l_returnflag").alias("activity_type"),
        day.alias("get_time"), F.when(F.col("l_linestatus") == "F", day).alias("use_time"),
        _money("l_extendedprice").cast("string").alias("coupon_amount"), F.col("l_linestatus").alias("coupon_code"),
    )


# -- change-capture family -------------------------------------------------------

def line_id() -> Column:
    """60-bit id of an order line from its md5, computed row by row without a shuffle."""
    def cents(name: str) -> Column:
        return F.round(F.col(name) * 100).cast("bigint")

    fields = [
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), cents("l_quantity"),
        cents("l_extendedprice"), cents("l_discount"), cents("l_tax"), F.col("l_returnflag"),
        F.col("l_linestatus"), F.unix_millis("l_shipdate"),
    ]
    digest = F.md5(F.concat_ws("|", *[f.cast("string") for f in fields]))
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint")


def lines(lineitem: DataFrame) -> DataFrame:
    return once(lineitem, id=line_id(), ms=F.unix_millis("l_shipdate"), price=_money("l_extendedprice"))


def _share(rate: str) -> Column:
    """Part of the line's price, exact to the cent."""
    return (F.col("price") * F.col(rate).cast("decimal(4,2)")).cast("decimal(16,2)").cast("string")


def order_detail(lineitem: DataFrame) -> DataFrame:
    price = F.col("price").cast("string")
    return lines(lineitem).select(
        F.col("l_quantity").cast("bigint").alias("sku_num"), F.col("ms").alias("create_time"),
        _share("l_tax").alias("split_coupon_amount"), F.col("l_partkey").alias("sku_id"),
        F.concat(F.lit("sku "), F.col("l_partkey")).alias("sku_name"), price.alias("order_price"), "id",
        F.col("l_orderkey").alias("order_id"), _share("l_discount").alias("split_activity_amount"),
        price.alias("split_total_amount"),
    )


def order_activity(lineitem: DataFrame) -> DataFrame:
    """Lines with a high discount took part in an activity."""
    return lines(lineitem.filter("l_discount >= 0.05")).select(
        F.col("id").alias("order_detail_id"), F.col("ms").alias("create_time"),
        F.col("l_linenumber").cast("bigint").alias("activity_rule_id"), F.col("l_suppkey").alias("activity_id"),
        F.col("l_partkey").alias("sku_id"), "id", F.col("l_orderkey").alias("order_id"),
    )


def order_coupon(lineitem: DataFrame) -> DataFrame:
    """Returned lines had used a coupon."""
    return lines(lineitem.filter("l_returnflag = 'R'")).select(
        F.col("id").alias("order_detail_id"), F.col("l_suppkey").alias("coupon_id"), F.col("ms").alias("create_time"),
        F.col("l_partkey").alias("sku_id"), "id", F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("coupon_use_id"),
    )


def order_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders with the customer's nation as province (a join on the customer key)."""
    ms = F.unix_millis("o_orderdate")
    total = _money("o_totalprice").cast("string")
    status = F.col("o_orderstatus")
    who = customer.select("c_custkey", "c_name", "c_nationkey")
    return orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        F.lit(3501).cast("bigint").alias("payment_way"), F.col("c_name").alias("consignee"), ms.alias("create_time"),
        (ms + 7 * DAY_MS).alias("refundable_time"), total.alias("original_total_amount"),
        F.lit("0.00").alias("coupon_reduce_amount"),
        F.when(status == "F", 1003).when(status == "P", 1005).otherwise(1006).cast("bigint").alias("order_status"),
        F.col("o_orderkey").alias("out_trade_no"), total.alias("total_amount"), F.col("o_custkey").alias("user_id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"), F.lit(None).cast("string").alias("consignee_tel"),
        F.col("o_orderpriority").alias("trade_body"), F.col("o_orderkey").alias("id"),
        F.lit("0.00").alias("activity_reduce_amount"), (ms + HOUR_MS).alias("operate_time"),
    )


def payment_info(orders: DataFrame) -> DataFrame:
    ms = F.unix_millis("o_orderdate") + DAY_MS
    return orders.select(
        (ms + 60_000).alias("callback_time"),
        F.when(F.col("o_orderpriority") < "3", "1101").when(F.col("o_orderpriority") < "5", "1102").otherwise("1103")
        .alias("payment_type"),
        _text("o_orderkey").alias("out_trade_no"), ms.alias("create_time"), F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").cast("string").alias("total_amount"), F.col("o_orderpriority").alias("subject"),
        F.when(F.col("o_orderstatus") == "O", "1601").otherwise("1602").alias("payment_status"),
        F.lit(None).cast("string").alias("callback_content"), F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"), ms.alias("operate_time"),
    )


def refund_info(lineitem: DataFrame) -> DataFrame:
    """Returned lines asked for a refund; final lines were approved."""
    return lines(lineitem.filter("l_returnflag = 'R'")).select(
        F.lit("1502").alias("refund_type"),
        F.when(F.col("l_linestatus") == "F", "0705").otherwise("0701").alias("refund_status"),
        F.col("ms").alias("create_time"), F.col("l_suppkey").alias("user_id"),
        F.col("l_quantity").cast("bigint").alias("refund_num"), F.lit("1301").alias("refund_reason_type"),
        F.col("price").cast("string").alias("refund_amount"), F.col("l_partkey").alias("sku_id"), "id",
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("line "), F.col("l_linenumber")).alias("refund_reason_txt"),
    )


def refund_payment(lineitem: DataFrame) -> DataFrame:
    return lines(lineitem.filter("l_returnflag = 'R'")).select(
        (F.col("ms") + DAY_MS).alias("callback_time"),
        F.when(F.col("l_tax") >= 0.04, "1101").otherwise("1102").alias("payment_type"),
        F.when(F.col("l_discount") >= 0.08, "1601").otherwise("1602").alias("refund_status"),
        F.col("ms").alias("create_time"), F.col("price").cast("string").alias("total_amount"),
        F.lit("refund").alias("subject"), _text("l_orderkey").alias("trade_no"), F.col("l_partkey").alias("sku_id"),
        F.lit(None).cast("string").alias("callback_content"), "id", F.col("l_orderkey").alias("order_id"),
        F.col("ms").alias("operate_time"),
    )


def cart_info(events: DataFrame) -> DataFrame:
    ms = F.unix_millis("ts")
    return _with_k(events).select(
        F.when(F.col("event_type") == "purchase", "1").otherwise("0").alias("is_ordered"),
        _money("value").cast("string").alias("cart_price"), _k().cast("bigint").alias("sku_num"),
        ms.alias("create_time"), _text("user_id").alias("user_id"), _k().cast("string").alias("sku_id"),
        F.concat(F.lit("sku "), _k()).alias("sku_name"), _text("event_id").alias("id"),
        ms.alias("operate_time"),
    )


def comment_info(conversations: DataFrame) -> DataFrame:
    turn_id = F.col("conv_id") * 100_000 + F.col("turn")
    role = F.col("role")
    return conversations.select(
        (F.lit(1_700_000_000_000) + turn_id * 10).alias("create_time"), _text("conv_id").alias("user_id"),
        F.when(role == "user", "1201").when(role == "assistant", "1202").otherwise("1203").alias("appraise"),
        F.col("text").alias("comment_txt"), role.alias("nick_name"), _text("turn").alias("sku_id"),
        turn_id.cast("string").alias("id"), _text("turn").alias("spu_id"), _text("conv_id").alias("order_id"),
    )


def sku_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.lit(1).cast("bigint").alias("is_sale"), F.col("p_type").alias("sku_desc"),
        F.substring_index("p_brand", "#", -1).cast("bigint").alias("tm_id"),
        F.lit(1_700_000_000_000).alias("create_time"), _money("p_retailprice").cast("string").alias("price"),
        F.lit(None).cast("string").alias("sku_default_img"), _text("p_size").alias("weight"),
        F.col("p_name").alias("sku_name"), F.col("p_partkey").alias("id"),
        F.col("p_size").cast("bigint").alias("spu_id"), F.col("p_size").cast("bigint").alias("category3_id"),
    )


# -- dimensions --------------------------------------------------------------------

def _code_dim(df: DataFrame, code: Column, name: Column) -> DataFrame:
    return df.select(code.alias("dic_code"), F.struct(code.alias("dic_code"), name.alias("dic_name")).alias("info"))


def base_dic(spark: SparkSession) -> DataFrame:
    rows = _values(spark, list(DICTIONARY.items()), "code, name")
    return _code_dim(rows, F.col("code"), F.col("name"))


def hashed_dic(spark: SparkSession) -> DataFrame:
    """The dictionary with the md5 of the code as row key."""
    return base_dic(spark).select(md5_key(F.col("dic_code")).alias("rowkey"), "info")


def base_province(nation: DataFrame) -> DataFrame:
    """Nations outside region 3; provinces of that region have no name."""
    return _code_dim(nation.filter("n_regionkey <> 3"), _text("n_nationkey"), F.col("n_name"))


def base_trademark(part: DataFrame) -> DataFrame:
    """Brands of parts; one brand is missing."""
    brands = part.select("p_brand").filter("p_brand <> 'Brand#13'").distinct()
    return _code_dim(brands, F.substring_index("p_brand", "#", -1), F.col("p_brand"))


# -- change records ------------------------------------------------------------------

def envelope(rows: DataFrame, table: str, op: Column, ts_ms: Column, pos: Column | None = None) -> DataFrame:
    """Change records of one table; deletes carry the old image. ``pos`` is the place in the log, by default 1."""
    fields = [name.split()[0] for name in CDC_TABLES[table].split(", ")]
    image = F.to_json(F.struct(*fields))
    place = F.lit("1") if pos is None else pos.cast("string")
    return rows.select(
        op.alias("op"),
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        F.create_map(F.lit("table"), F.lit(table), F.lit("db"), F.lit("shop"), F.lit("pos"), place).alias("source"),
        ts_ms.alias("ts_ms"),
    )


#: What a change of a row is: its kind, its place in the log, and which version of the row it carries.
_CHANGE = "array<struct<_op:string,_pos:int,_version:string>>"


def _changes(*steps: tuple[str, int, str]) -> Column:
    return F.array(*[F.struct(F.lit(op), F.lit(pos), F.lit(version)) for op, pos, version in steps]).cast(_CHANGE)


def _changed(rows: DataFrame, changes: Column) -> DataFrame:
    """Each row once for each of its changes, so that the table is read, and a line's id made, once."""
    return rows.select("*", F.inline(changes))


CAPTURED = tuple(t for t in CDC_TABLES if t != "table_process_dim")


def changes_of(spark: SparkSession, sf_dir: str, table: str, versions: bool = False) -> list[DataFrame]:
    """Change records of one captured table, in one pass over what it is derived from.

    ``versions`` gives tables without changes of their own some, and deleted rows; the final rows stay the same.
    """
    created, operated = F.col("create_time"), F.col("operate_time")
    if table == "order_info":
        # An order is placed, then changes its status.
        rows = order_info(load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer"))
        rows = _changed(rows, _changes(("c", 1, "placed"), ("u", 1, "last")))
        placed = F.col("_version") == "placed"
        rows = rows.withColumn("order_status", F.when(placed, F.lit(1001).cast("bigint")).otherwise(F.col("order_status")))
        return [envelope(rows, table, F.col("_op"), F.when(placed, created).otherwise(operated))]
    if table == "cart_info":
        # A cart line is added; an ordered one is updated, a small one removed.
        rows = cart_info(load(spark, sf_dir, "events"))
        added, ordered = ("c", 1, "added"), F.col("is_ordered") == "1"
        removed = ~ordered & (F.col("sku_num") < 20)
        rows = _changed(rows, F.when(ordered, _changes(added, ("u", 1, "last"))).when(
            removed, _changes(added, ("d", 1, "last"))).otherwise(_changes(added)))
        rows = rows.withColumn("is_ordered", F.when(F.col("_version") == "added", "0").otherwise(F.col("is_ordered")))
        later = F.when(F.col("_op") == "u", 1000).when(F.col("_op") == "d", 2000).otherwise(0)
        return [envelope(rows, table, F.col("_op"), created + later)]
    if table == "sku_info":
        # A sku is known under a draft name first.
        rows = sku_info(load(spark, sf_dir, "part"))
        rows = _changed(rows, _changes(("r", 1, "draft"), ("u", 1, "last")))
        draft = F.col("_version") == "draft"
        rows = rows.withColumn("sku_name", F.when(draft, "draft").otherwise(F.col("sku_name")))
        return [envelope(rows, table, F.col("_op"), F.when(draft, created).otherwise(created + 1000))]
    source, build = {
        "order_detail": ("lineitem", order_detail),
        "order_detail_activity": ("lineitem", order_activity),
        "order_detail_coupon": ("lineitem", order_coupon),
        "order_refund_info": ("lineitem", refund_info),
        "refund_payment": ("lineitem", refund_payment),
        "payment_info": ("orders", payment_info),
        "comment_info": ("conversations", comment_info),
    }[table]
    rows = build(load(spark, sf_dir, source))
    return [_versions(rows, table) if versions else envelope(rows, table, F.lit("c"), created)]


#: What a first version of a row says in place of the last one.
DRAFTS = {
    "order_detail": ("sku_num", -1), "payment_info": ("payment_status", "1601"), "order_refund_info": ("refund_num", -1),
    "refund_payment": ("refund_status", "0701"), "comment_info": ("comment_txt", "draft"),
}


def _versions(rows: DataFrame, table: str) -> DataFrame:
    """A quarter of the rows with a first version, and rows that were deleted, all within one millisecond."""
    kind = dict(rows.dtypes)
    share = F.pmod(F.xxhash64("id"), F.lit(16))
    rows = _changed(rows, F.when(share < 4, _changes(("c", 1, "draft"), ("u", 2, "last"))).when(
        share == 5, _changes(("c", 1, "last"), ("c", 1, "ghost"), ("d", 2, "ghost"))).otherwise(_changes(("c", 1, "last"))))
    draft = F.col("_version") == "draft"
    ghost = F.concat(F.lit("-"), F.col("id").cast("string")).cast(kind["id"])
    new = {"id": F.when(F.col("_version") == "ghost", ghost).otherwise(F.col("id"))}
    if table in DRAFTS:
        column, value = DRAFTS[table]
        new[column] = F.when(draft, F.lit(value).cast(kind[column])).otherwise(F.col(column))
    else:
        new["create_time"] = F.when(draft, F.col("create_time") - 1).otherwise(F.col("create_time"))
        new["order_id"] = F.when(draft, F.lit(-1).cast("bigint")).otherwise(F.col("order_id"))
    return envelope(rows.withColumns(new), table, F.col("_op"), F.col("create_time"), F.col("_pos"))


def cdc_feed(spark: SparkSession, sf_dir: str, *tables: str, versions: bool = False) -> DataFrame:
    """Change records of the named tables (all if none) in one frame, as one topic carries them.

    The table name is a constant of each part, so routing to one table prunes the
    scans of the others; naming the tables only saves planning them first.
    """
    parts = [part for t in (tables or CAPTURED) for part in changes_of(spark, sf_dir, t, versions)]
    return reduce(DataFrame.unionByName, parts)


def config_changes(spark: SparkSession) -> DataFrame:
    rows = _values(spark, CONFIG_CHANGES, "op, source_table, sink_table, sink_row_key, sink_columns, ts_ms")
    rows = rows.withColumns({"sink_family": F.lit("info"), "ts_ms": F.col("ts_ms").cast("bigint")})
    fields = ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"]
    image = F.to_json(F.struct(*fields))
    deleted = F.col("op") == "d"
    return rows.select(
        "op", F.when(deleted, image).alias("before"), F.when(~deleted, image).alias("after"),
        F.create_map(F.lit("table"), F.lit("table_process_dim")).alias("source"), "ts_ms",
    )


def payment_feed(events: DataFrame) -> list[DataFrame]:
    """Changes of payments and orders, in the parts in which they arrive; the final rows are those of the tables.

    Payments come first: some under another amount and time, some under another order, some that will be
    deleted. Then come the corrections and repeats, then orders under a draft shop, then the orders as
    they stay. All parts are projections of the events.
    """
    from tidemart.streaming.payments import FEED

    def part(rows: DataFrame, kind: str, op: str, pos: int) -> DataFrame:
        schema = T.StructType.fromDDL(FEED)
        row = {k: F.lit(None).cast(schema[k].dataType) for k in ("payment", "order")}
        row[kind] = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema[kind].dataType])
        return rows.select(
            F.lit(kind).alias("kind"), F.lit(op).alias("op"), F.lit(pos).cast("bigint").alias("pos"),
            row["payment"].alias("payment"), row["order"].alias("order"))

    payments, orders = trade_payment(events), trade_order(events)
    share = F.pmod(F.xxhash64("order_id"), F.lit(16))
    changed, moved, ghosts, again = payments.filter(share < 4), payments.filter(share == 6), payments.filter(share == 5), payments.filter(share == 7)
    ghosts = ghosts.withColumn("pay_id", F.concat(F.lit("x"), "pay_id"))
    drafts = changed.withColumns({
        "pay_amount": (F.col("pay_amount") + 1).cast("decimal(10,2)"),
        "pay_time": F.when(share < 2, F.col("pay_time") - F.expr("interval 1 day")).otherwise(F.col("pay_time") + F.expr("interval 1 minute")),
        "pay_status": F.when(share == 3, "pending").otherwise(F.col("pay_status")),
    })
    other = moved.withColumn("order_id", F.concat(F.lit("-"), "order_id"))
    unchanged = payments.filter((share >= 4) & (share != 6))
    shop = orders.withColumn("shop_id", F.concat(F.lit("draft"), F.substring("order_id", -1, 1)))
    parts = [
        [part(drafts, "payment", "c", 1), part(other, "payment", "c", 1), part(unchanged, "payment", "c", 1), part(ghosts, "payment", "c", 1)],
        [part(changed, "payment", "u", 3), part(drafts, "payment", "u", 2), part(moved, "payment", "u", 2),
         part(again, "payment", "c", 1), part(ghosts, "payment", "d", 2)],
        [part(shop.filter(share < 8), "order", "c", 1), part(orders.filter(share >= 8), "order", "c", 1)],
        [part(orders.filter(share < 8), "order", "u", 2), part(shop.filter(share >= 8).withColumn("order_id", F.concat(F.lit("-"), "order_id")), "order", "d", 2)],
    ]
    return [reduce(DataFrame.unionByName, p) for p in parts]


def midstream_config(spark: SparkSession) -> DataFrame:
    """Change records of ``MIDSTREAM_CONFIG``; an update carries both images."""
    rows = _values(spark, MIDSTREAM_CONFIG, "op, source_table, old, new, sink_row_key, ts_ms")

    def image(sink: str) -> Column:
        return F.to_json(F.struct(
            "source_table", F.col(sink).alias("sink_table"), F.lit("").alias("sink_columns"), F.lit("info").alias("sink_family"), "sink_row_key"))

    return rows.select(
        "op", F.when(F.col("old") != "", image("old")).alias("before"), F.when(F.col("new") != "", image("new")).alias("after"),
        F.create_map(F.lit("table"), F.lit("table_process_dim"), F.lit("pos"), F.lit("0")).alias("source"), F.col("ts_ms").cast("bigint").alias("ts_ms"))


# -- application log -----------------------------------------------------------------

def app_log(events: DataFrame) -> DataFrame:
    """Log records as JSON ``value`` with their arrival number ``log_id``; some are malformed."""
    kind, k, user = F.col("event_type"), _k(), _text("user_id")
    new = (kind == "signup") | (k < 30)
    item = lambda n, *more: F.struct(n.alias("item"), *more)
    record = F.struct(
        F.struct(
            F.concat(F.lit("d_"), user).alias("mid"), F.when(new, "1").otherwise("0").alias("is_new"),
            user.alias("uid"),
        ).alias("common"),
        F.when(kind != "signup", F.struct(
            F.when(kind == "view", "home").when(kind == "click", "good_detail").otherwise("cart").alias("page_id"),
            k.cast("string").alias("item"),
        )).alias("page"),
        F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"), k.alias("ad_id"))).alias("start"),
        F.when((kind == "error") | ((kind == "signup") & (k >= 80)), F.struct(
            k.alias("code"), F.concat(F.lit("e"), k).alias("msg"))).alias("err"),
        F.when((kind == "view") & (k >= 10), F.array(
            item(k, F.lit(1).alias("pos")), item(k + 1, F.lit(2).alias("pos"))))
        .when(kind == "view", F.array().cast("array<struct<item:int,pos:int>>"))
        .when(kind == "signup", F.array(item(k, F.lit(1).alias("pos")))).alias("displays"),
        F.when(kind == "click", F.array(item(k, F.lit("cart_add").alias("action_id"))))
        .when(kind == "purchase", F.array(
            item(k, F.lit("cart_add").alias("action_id")), item(k, F.lit("pay").alias("action_id"))))
        .alias("actions"),
        F.unix_millis("ts").alias("ts"),
    )
    bad = (kind == "error") & (k >= 90)
    return _with_k(events).select(
        F.col("event_id").alias("log_id"),
        F.when(bad, F.concat(F.lit("{bad "), F.col("event_id"))).otherwise(F.to_json(record)).alias("value"),
    )


# -- comments and words ----------------------------------------------------------------

def comment_messages(conversations: DataFrame) -> DataFrame:
    """Comments as the word check receives them."""
    turn_id = F.col("conv_id") * 100_000 + F.col("turn")
    return conversations.select(
        F.col("conv_id").alias("user_id"), F.col("role").alias("info_consignee"), turn_id.alias("ts_ms"),
        F.lit("20240101").alias("ds"), F.col("text").alias("commentTxt"),
    )


def words(conversations: DataFrame) -> DataFrame:
    """Word list with repeats: the last comma-separated pieces of the users' comments."""
    from tidemart.functions.text import last_token

    return conversations.filter("role = 'user'").select(last_token(F.col("text")).alias("word"))
