"""Test tables seen as logs, orders, change entries and sale details.

`events`, `orders` and the other tables are those of TESTDATA.md. Choices by id
(version, area, channel) only fill fields the test tables lack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse.operators.changefeed import DEFAULT_ROUTES

# The vocabularies of the log producers.
VERSIONS = ["1.2.0", "1.1.2", "1.1.3", "1.1.1"]
AREAS = ["beijing", "shanghai", "guangdong", "hebei", "heilongjiang", "shandong", "tianjin",
         "shan3xi", "shan1xi", "sichuan"]
CHANNELS = ["xiaomi", "huawei", "wandoujia", "360", "tencent", "baidu", "website"]
SYSTEMS = ["ios", "andriod"]
IOS_CHANNEL = "appstore"
APP_ID = "shop"

EVENT_NAMES = {"click": "clickItem", "purchase": "coupon", "signup": "coupon",
               "view": "addCart", "error": "addComment"}


def _pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def between_days(rows: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows whose time lies on `first` .. `last`, as a range a Parquet scan can skip by."""
    kind = rows.schema[column].dataType.typeName()
    edge = lambda day, shift: F.date_add(F.lit(day).cast("date"), shift).cast(kind)
    return rows.filter((F.col(column) >= edge(first, 0)) & (F.col(column) < edge(last, 1)))


def startup_logs(events: DataFrame) -> DataFrame:
    """One app start per event; `event_id` breaks ties between equal times."""
    os = _pick(SYSTEMS, F.col("event_id"))
    return events.select(
        F.concat(F.lit("mid_"), F.col("user_id")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit(APP_ID).alias("appid"),
        _pick(AREAS, F.col("event_id")).alias("area"),
        os.alias("os"),
        F.when(os == "ios", IOS_CHANNEL).otherwise(_pick(CHANNELS, F.col("event_id"))).alias("ch"),
        F.lit("startup").alias("type"),
        _pick(VERSIONS, F.col("event_id")).alias("vs"),
        epoch_ms(F.col("ts")).alias("ts"),
        "event_id")


def behaviour_events(events: DataFrame, devices: int = 5) -> DataFrame:
    """User actions on few shared devices, so that accounts meet on one device."""
    name = F.coalesce(*[F.when(F.col("event_type") == kind, F.lit(evid))
                        for kind, evid in EVENT_NAMES.items()])
    return events.select(
        F.concat(F.lit("mid_"), F.pmod("user_id", F.lit(devices))).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit(APP_ID).alias("appid"),
        _pick(AREAS, F.col("event_id")).alias("area"),
        _pick(SYSTEMS, F.col("event_id")).alias("os"),
        F.lit("event").alias("type"),
        name.alias("evid"),
        F.pmod("event_id", F.lit(7)).alias("pgid"),
        F.pmod("event_id", F.lit(11)).alias("npgid"),
        F.pmod("event_id", F.lit(50)).alias("itemid"),
        epoch_ms(F.col("ts")).alias("ts"),
        "event_id")


def client_logs(events: DataFrame) -> DataFrame:
    """Raw client lines: starts, actions, lines without a type and broken lines.

    `arrived` is the server time of each line. The clients' own `ts` is wrong.
    """
    kind = F.when(F.col("event_type") == "signup", "startup").when(
        F.col("event_type") != "error", "event")
    body = F.to_json(F.struct(
        kind.alias("type"),
        F.concat(F.lit("mid_"), F.col("user_id")).alias("mid"),
        F.col("event_id"),
        F.struct(F.col("value").alias("amount")).alias("extra"),
        F.lit(1).alias("ts")))
    broken = F.pmod("event_id", F.lit(97)) == 0
    return events.select(
        F.when(broken, F.lit('{"type":"startup",')).otherwise(body).alias("value"),
        epoch_ms(F.col("ts")).alias("arrived"))


def as_json(rows: DataFrame, *extra: str) -> DataFrame:
    """Rows as one-line JSON payloads, with `extra` columns kept beside them."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), *extra)


def order_messages(orders: DataFrame, customer: DataFrame | None = None) -> DataFrame:
    """Order fields as the messages carry them: all text.

    Names and provinces come from `customer`; leave it out when they are not
    needed, and no join is made.
    """
    hours = F.make_interval(hours=F.pmod("o_orderkey", F.lit(24)).cast("int"))
    created = F.date_format(F.col("o_orderdate").cast("timestamp") + hours, "yyyy-MM-dd HH:mm:ss")
    columns = [
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.concat(F.lit("138"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("consignee_tel"),
        created.alias("create_time"),
    ]
    if customer is not None:
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        columns += [F.col("c_name").alias("consignee"),
                    F.col("c_nationkey").cast("string").alias("province_id")]
    return orders.select(*columns)


def repeated_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Every order as it was placed and, for each third, as it was changed a day later."""
    placed = order_messages(orders, customer).withColumn("operate_time", F.col("create_time"))
    later = F.date_format(F.col("create_time").cast("timestamp") + F.make_interval(days=F.lit(1)), "yyyy-MM-dd HH:mm:ss")
    changed = placed.filter(F.pmod(F.col("id").cast("long"), F.lit(3)) == 0).withColumns({
        "operate_time": later, "order_status": F.lit("X"), "total_amount": F.lit("1.00")})
    return changed.unionByName(placed)


def damaged_orders(orders: DataFrame) -> DataFrame:
    """Order payloads of which some cannot be read, each in a different way."""
    good = order_messages(orders)
    key = F.col("id").cast("long")
    return as_json(good.select(
        "id", "user_id", "order_status",
        F.when(F.pmod(key, F.lit(41)) == 0, "n/a").otherwise(F.col("total_amount")).alias("total_amount"),
        F.when(F.pmod(key, F.lit(43)) != 0, F.col("consignee_tel")).alias("consignee_tel"),
        F.when(F.pmod(key, F.lit(47)) == 0, F.substring("create_time", 1, 10))
        .otherwise(F.col("create_time")).alias("create_time"),
    )).select(F.when(F.pmod(F.get_json_object("value", "$.id").cast("long"), F.lit(53)) == 0,
                     F.lit("{broken")).otherwise(F.col("value")).alias("value"))


def damaged_startups(events: DataFrame) -> DataFrame:
    """Start logs of which some cannot be used: no device, a time out of range or none, broken."""
    key = F.col("event_id")
    logs = startup_logs(events).withColumns({
        "mid": F.when(F.pmod(key, F.lit(41)) != 0, F.col("mid")),
        "ts": F.when(F.pmod(key, F.lit(43)) == 0, F.lit(2**63 - 1)).when(F.pmod(key, F.lit(47)) != 0, F.col("ts"))})
    return as_json(logs, "event_id").select(
        F.when(F.pmod(key, F.lit(37)) == 0, F.lit("{broken")).otherwise(F.col("value")).alias("value"))


def damaged_changes(orders: DataFrame) -> DataFrame:
    """Change-feed messages of which some are broken or name no table."""
    key = F.col("o_orderkey")
    return orders.select(
        F.when(F.pmod(key, F.lit(59)) == 0, F.lit('{"table":')).when(
            F.pmod(key, F.lit(61)) == 0, F.lit('{"entry_type":"ROWDATA"}')).otherwise(
            F.to_json(F.struct(F.lit("ROWDATA").alias("entry_type"), F.lit("order_info").alias("table"),
                               F.lit("INSERT").alias("type")))).alias("value"))


def change_entries(orders: DataFrame) -> DataFrame:
    """Change-feed entries of one row each; some of another table, some updates."""
    fields = ["id", "user_id", "total_amount", "order_status", "consignee_tel", "create_time"]
    messages = order_messages(orders)
    key = F.col("id").cast("long")
    cells = F.array(*[F.struct(F.lit(f).alias("name"), F.col(f).alias("value")) for f in fields])
    routed = next(iter(DEFAULT_ROUTES))
    return messages.select(
        F.when(F.pmod(key, F.lit(100)) == 50, "TRANSACTIONEND").otherwise("ROWDATA").alias("entry_type"),
        F.when(F.pmod(key, F.lit(10)) == 9, "user_info").otherwise(routed).alias("table"),
        F.when(F.col("order_status") == "P", "UPDATE").otherwise("INSERT").alias("type"),
        F.array(F.struct(cells.alias("after"))).alias("rows"))


def sale_details(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                 part: DataFrame) -> DataFrame:
    """Order lines with buyer and item; market segment stands for gender, part size for age."""
    return (lineitem
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                            F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
                .alias("order_detail_id"),
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("user_id"),
                F.col("p_partkey").alias("sku_id"),
                F.col("c_mktsegment").alias("user_gender"),
                F.col("p_size").alias("user_age"),
                F.pmod("o_custkey", F.lit(5)).cast("int").alias("user_level"),
                F.col("p_retailprice").alias("sku_price"),
                F.col("p_name").alias("sku_name"),
                F.col("p_brand").alias("sku_tm_id"),
                F.to_date("o_orderdate").cast("string").alias("dt")))
