"""Queries over the test tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storepulse import schemas
from storepulse.functions import times
from storepulse.operators import alerts, changefeed, decode, first_launch, routing
from storepulse.operators.sliding import AlertRule
from storepulse.plans import metrics, regions, sale_detail
from storepulse.plans.detail_store import DetailStore
from storepulse.session import default_work_root, work_folder
from storepulse.sources import bindings, changes, replay, tables, topics
from storepulse.streaming import jobs, sinks, upkeep
from storepulse.streaming.alert_job import CouponAlertJob
from storepulse.streaming.counters import Counters

# The operators for training data are an addition: without their folder the rest works.
_LLM = find_spec("storepulse.llm")
if _LLM and _LLM.origin:
    from storepulse.llm import queries as llm_queries
else:
    llm_queries = None

LOG_DAY, LOG_DAY_BEFORE = "2024-01-15", "2024-01-14"
ORDER_DAY, ORDER_DAY_BEFORE = "1997-01-15", "1997-01-14"
EMPTY_DAY = "2035-06-01"
FIRST_DAY = "1970-01-01"
KEYWORD = "bo"
ITEM = "bolt"
SLICES = 3
STATE_PARTITIONS = 16
BROAD, LIVE = AlertRule(window_s=3600, slide_s=300), AlertRule()


# -- inputs -----------------------------------------------------------------

def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _logs(spark: SparkSession, sf: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """App starts with day and hour; days outside first .. last are skipped in the scan."""
    events = _table(spark, sf, "events")
    if first:
        events = bindings.between_days(events, "ts", first, last)
    return bindings.startup_logs(events).withColumns({
        "log_date": times.log_date(F.col("ts")), "log_hour": times.log_hour(F.col("ts"))})


def _dau(spark: SparkSession, sf: str, first: str, last: str) -> DataFrame:
    found = first_launch.earliest_per_key(_logs(spark, sf, first, last))
    return found.withColumn("log_hour", times.log_hour(F.col("ts")))


def _orders(spark: SparkSession, sf: str, first: str, last: str) -> DataFrame:
    rows = bindings.between_days(_table(spark, sf, "orders"), "o_orderdate", first, last)
    return decode.accepted(decode.decode_order(bindings.as_json(bindings.order_messages(rows))))


def _hourly_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"dau": _dau(spark, sf, LOG_DAY_BEFORE, LOG_DAY),
            "orders": _orders(spark, sf, ORDER_DAY_BEFORE, ORDER_DAY)}


def _behaviour(spark: SparkSession, sf: str) -> DataFrame:
    return bindings.behaviour_events(_table(spark, sf, "events"))


# -- decoding and ingest ------------------------------------------------------

def startup_decode_dates(spark, sf):
    lines = bindings.as_json(bindings.startup_logs(_table(spark, sf, "events")))
    logs = decode.accepted(decode.decode_startup(lines, extra=["event_id"]))
    return logs.withColumn("event_id", F.col("event_id").cast("long"))


def event_decode(spark, sf):
    lines = bindings.as_json(_behaviour(spark, sf))
    logs = decode.accepted(decode.decode_event(lines, extra=["event_id"]))
    return logs.withColumn("event_id", F.col("event_id").cast("long"))


def order_decode_mask(spark, sf):
    lines = bindings.as_json(bindings.order_messages(
        _table(spark, sf, "orders"), _table(spark, sf, "customer")))
    return decode.accepted(decode.decode_order(lines)).select(*schemas.ORDER_COLUMNS)


def order_quarantine(spark, sf):
    decoded = decode.decode_order(bindings.damaged_orders(_table(spark, sf, "orders")))
    return decode.quarantined(decoded).groupBy(F.col("_error").alias("error")).agg(
        F.count("*").alias("n"))


def startup_quarantine(spark, sf):
    """Reasons for which damaged start logs are set aside, with their numbers."""
    decoded = decode.decode_startup(bindings.damaged_startups(_table(spark, sf, "events")))
    return decode.quarantined(decoded).groupBy(F.col("_error").alias("error")).agg(F.count("*").alias("n"))


def change_quarantine(spark, sf):
    entries = changes.parse_entries(bindings.damaged_changes(_table(spark, sf, "orders")))
    return decode.quarantined(entries).groupBy(F.col("_error").alias("error")).agg(F.count("*").alias("n"))


def _read_back(stamped: DataFrame) -> DataFrame:
    fields = F.from_json("value", "event_id long, ts long, extra struct<amount: double>")
    return stamped.select("topic", fields.alias("f")).select(
        "f.event_id", "topic", "f.ts", F.col("f.extra.amount").alias("amount"))


def log_route(spark, sf):
    lines = bindings.client_logs(_table(spark, sf, "events"))
    return _read_back(decode.accepted(routing.stamp_and_route(lines, now=F.col("arrived"))))


def change_feed_inserts(spark, sf):
    entries = changes.parse_entries(bindings.as_json(
        bindings.change_entries(_table(spark, sf, "orders"))))
    orders = decode.accepted(decode.decode_order(changefeed.flatten_changes(entries)))
    return orders.select("id", "user_id", "total_amount", "create_date")


# -- first launches -----------------------------------------------------------

def first_launch_batch(spark, sf):
    first = first_launch.earliest_per_key(_logs(spark, sf))
    return first.select("mid", "log_date", times.log_hour(F.col("ts")).alias("log_hour"), "event_id", "ts")


def first_launch_unseen(spark, sf):
    logs = _logs(spark, sf)
    morning = logs.filter(F.col("log_hour") < "12").select("mid", "log_date")
    rest = logs.filter(F.col("log_hour") >= "12").select("event_id", "mid", "log_date")
    return first_launch.unseen(rest, morning, salts=4)


# -- metrics --------------------------------------------------------------------

def dau_day(spark, sf):
    return metrics.dau_total(_dau(spark, sf, LOG_DAY, LOG_DAY), LOG_DAY)


def dau_empty_day(spark, sf):
    return metrics.dau_total(_dau(spark, sf, EMPTY_DAY, EMPTY_DAY), EMPTY_DAY)


def dau_hour(spark, sf):
    return metrics.dau_by_hour(_dau(spark, sf, LOG_DAY, LOG_DAY), LOG_DAY)


def new_devices_day(spark, sf):
    return metrics.new_devices(_logs(spark, sf, FIRST_DAY, LOG_DAY), LOG_DAY)


def order_amount_day(spark, sf):
    return metrics.order_amount(_orders(spark, sf, ORDER_DAY, ORDER_DAY), ORDER_DAY)


def order_amount_empty_day(spark, sf):
    return metrics.order_amount(_orders(spark, sf, EMPTY_DAY, EMPTY_DAY), EMPTY_DAY)


def order_amount_hour(spark, sf):
    return metrics.order_amount_by_hour(_orders(spark, sf, ORDER_DAY, ORDER_DAY), ORDER_DAY)


def _totals_input(spark, sf, order_day):
    # Orders and logs of the test data lie in different years: the orders' day
    # is moved to the logs' day, so that one date answers for both.
    orders = _orders(spark, sf, order_day, order_day).withColumn("create_date", F.lit(LOG_DAY))
    return _dau(spark, sf, LOG_DAY, LOG_DAY), orders, LOG_DAY, _logs(spark, sf, FIRST_DAY, LOG_DAY)


def realtime_total(spark, sf):
    return metrics.realtime_total(*_totals_input(spark, sf, ORDER_DAY))


def realtime_total_json(spark, sf):
    return metrics.realtime_total_json(*_totals_input(spark, sf, EMPTY_DAY))


def realtime_hour_dau(spark, sf):
    return metrics.realtime_hour(_hourly_tables(spark, sf), schemas.METRIC_DAU, LOG_DAY)


def realtime_hour_amount(spark, sf):
    return metrics.realtime_hour(_hourly_tables(spark, sf), schemas.METRIC_ORDER_AMOUNT, ORDER_DAY)


def realtime_hour_map(spark, sf):
    maps = metrics.realtime_hour_maps(_hourly_tables(spark, sf), schemas.METRIC_ORDER_AMOUNT, ORDER_DAY)
    joined = lambda m: F.array_join(F.transform(
        F.sort_array(F.map_entries(m)),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(18,2)").cast("string"))), ",")
    return maps.select(F.explode(F.array(
        F.struct(F.lit("yesterday").alias("day_label"), joined("yesterday").alias("series")),
        F.struct(F.lit("today").alias("day_label"), joined("today").alias("series")))).alias("r")
    ).select("r.*")


def realtime_hour_json(spark, sf):
    return metrics.realtime_hour_json(_hourly_tables(spark, sf), schemas.METRIC_DAU, LOG_DAY)


# -- metrics on stored tables -------------------------------------------------------

def _stored_launches(spark, sf):
    path = work_folder(spark, "stored-launches")
    launches = first_launch.earliest_per_key(_logs(spark, sf)).select(
        "mid", "ts", times.log_hour(F.col("ts")).alias("log_hour"), "log_date")
    tables.write_daily(launches, path, "log_date")
    return tables.read_daily(spark, path, launches.schema)


def _stored_orders(spark, sf):
    path = work_folder(spark, "stored-orders")
    orders = decode.accepted(decode.decode_order(bindings.as_json(
        bindings.order_messages(_table(spark, sf, "orders"))))).select(
            "id", "total_amount", "create_hour", "create_date", F.substring("create_date", 1, 7).alias("create_month"))
    tables.write_daily(orders, path, "create_month")  # years of orders: a folder per month
    return tables.read_daily(spark, path, orders.schema)


def _stored_first_days(spark, launches):
    days = upkeep.FirstDays(work_folder(spark, "stored-first-days"))
    days.apply(launches, 0)
    return days


def stored_dau_hour(spark, sf):
    return metrics.dau_by_hour(_stored_launches(spark, sf), LOG_DAY)


def stored_order_amount_hour(spark, sf):
    month = _stored_orders(spark, sf).filter(F.col("create_month") == ORDER_DAY[:7])
    return metrics.order_amount_by_hour(month, ORDER_DAY)


def stored_realtime_total(spark, sf):
    launches = _stored_launches(spark, sf)
    orders = _stored_orders(spark, sf)
    days = _stored_first_days(spark, launches)
    # Orders lie in other years than logs: their day is read by its own date, then renamed.
    moved = orders.filter((F.col("create_month") == ORDER_DAY[:7]) & (F.col("create_date") == ORDER_DAY)).withColumn("create_date", F.lit(LOG_DAY))
    return metrics.realtime_total(launches, moved, LOG_DAY, days=days.of_day(spark, LOG_DAY))


# -- alerts -----------------------------------------------------------------------

def _alerts(spark, sf, rule, every_window):
    found = alerts.coupon_alerts(_behaviour(spark, sf), rule, every_window,
                                 staging=work_folder(spark, "alerts"))
    return found.select("alert_id", "mid", (F.col("ts") / 1000).cast("long").alias("w_end"), "kind", "name",
                        "copies", "n_uids", "n_items", "n_events")


def coupon_alert_windows(spark, sf):
    return _alerts(spark, sf, BROAD, True)


def coupon_alert_windows_live(spark, sf):
    return _alerts(spark, sf, LIVE, True)


def coupon_alert_minute(spark, sf):
    return _alerts(spark, sf, LIVE, False)


# -- streams: bounded replays, then a batch read of what they wrote -----------------

def stream_first_launch(spark, sf):
    root = work_folder(spark, "first-launch")
    lines = bindings.startup_logs(_table(spark, sf, "events"))
    replay.feed_in_time_order(
        lines, "ts", SLICES,
        lambda part: replay.write_topic(bindings.as_json(part), f"{root}/topics", "startup"),
        lambda: jobs.first_launches(topics.read_folder(spark, f"{root}/topics", "startup"),
                                    f"{root}/table", state_partitions=STATE_PARTITIONS,
                                    once=True).awaitTermination())
    stored = tables.read_table(spark, f"{root}/table", schemas.FIRST_LAUNCH_TABLE)
    return stored.select("mid", "log_date")


def stream_first_launch_exact(spark, sf):
    root = work_folder(spark, "first-launch-exact")
    lines = bindings.startup_logs(_table(spark, sf, "events"))
    replay.feed_in_time_order(
        lines, "ts", SLICES,
        lambda part: replay.write_topic(bindings.as_json(part), f"{root}/topics", "startup"),
        lambda: jobs.first_launches_exact(
            topics.read_folder(spark, f"{root}/topics", "startup"), f"{root}/table",
            order=("ts", "event_id"), extra=("event_id",), once=True).awaitTermination())
    stored = tables.read_table(spark, f"{root}/table", schemas.FIRST_LAUNCH_TABLE, ["event_id"])
    return stored.select("mid", "log_date", F.col("event_id").cast("long").alias("event_id"))


def stream_orders(spark, sf):
    root = work_folder(spark, "orders")
    lines = bindings.order_messages(_table(spark, sf, "orders"), _table(spark, sf, "customer"))
    replay.write_topic(bindings.as_json(lines), f"{root}/topics", "order")
    jobs.ingest_orders(topics.read_folder(spark, f"{root}/topics", "order"), f"{root}/table",
                       partition="create_month", once=True).awaitTermination()
    return tables.read_orders(spark, f"{root}/table")


def stream_orders_upsert(spark, sf):
    """Two versions of many orders in one batch; one row per order is read."""
    root = work_folder(spark, "orders-upsert")
    lines = bindings.repeated_orders(_table(spark, sf, "orders"), _table(spark, sf, "customer"))
    replay.write_topic(bindings.as_json(lines), f"{root}/topics", "order")
    jobs.ingest_orders(topics.read_folder(spark, f"{root}/topics", "order"), f"{root}/table",
                       partition="create_month", once=True).awaitTermination()
    return tables.read_orders(spark, f"{root}/table").select(
        "id", "order_status", "total_amount", "create_time", "operate_time", "consignee", "create_date")


def stream_first_launch_late(spark, sf):
    """The stream of `stream_first_launch` with the last days first: most launches are late."""
    root = work_folder(spark, "late-launch")
    lines = bindings.startup_logs(_table(spark, sf, "events")).withColumn("back", -F.col("ts"))
    replay.feed_in_time_order(
        lines, "back", SLICES,
        lambda part: replay.write_topic(bindings.as_json(part.drop("back")), f"{root}/topics", "startup"),
        lambda: jobs.first_launches(topics.read_folder(spark, f"{root}/topics", "startup"), f"{root}/table",
                                    state_partitions=STATE_PARTITIONS, once=True).awaitTermination())
    return upkeep.launches(spark, f"{root}/table").select("mid", "log_date")


def stream_counters(spark, sf):
    """Rows read, rejected and kept of every batch of the exact launch job."""
    root = work_folder(spark, "counters")
    lines = bindings.startup_logs(_table(spark, sf, "events"))
    counters = Counters(f"{root}/counters")

    def run():
        query = jobs.first_launches_exact(topics.read_folder(spark, f"{root}/topics", "startup"), f"{root}/table",
                                          counters=counters, once=True)
        query.awaitTermination()
        counters.wait(query)

    replay.feed_in_time_order(
        lines, "ts", SLICES,
        lambda part: replay.write_topic(bindings.as_json(part), f"{root}/topics", "startup"), run)
    return counters.read(spark)


def stream_first_days(spark, sf):
    """Every device's first day, kept by the launch job; the days arrive last first."""
    root = work_folder(spark, "first-days")
    lines = bindings.startup_logs(_table(spark, sf, "events")).withColumn("back", -F.col("ts"))
    replay.feed_in_time_order(
        lines, "back", SLICES,
        lambda part: replay.write_topic(bindings.as_json(part.drop("back")), f"{root}/topics", "startup"),
        lambda: jobs.first_launches_exact(topics.read_folder(spark, f"{root}/topics", "startup"), f"{root}/table",
                                          first_days=True, once=True).awaitTermination())
    return upkeep.FirstDays(f"{root}/table/_first_days").table.read(spark)


def _upserted_orders(spark, sf):
    """Orders as placed, then as changed, then some changed ones again: three batches."""
    root = work_folder(spark, "orders-keyed")
    lines = bindings.repeated_orders(_table(spark, sf, "orders"), _table(spark, sf, "customer"))
    changed = F.col("order_status") == "X"
    for part in (lines.filter(~changed), lines.filter(changed), lines.filter(changed & (F.length("id") % 2 == 0))):
        replay.write_topic(bindings.as_json(part), f"{root}/topics", "order")
        jobs.upsert_orders(topics.read_folder(spark, f"{root}/topics", "order"), f"{root}/table",
                           once=True).awaitTermination()
    return upkeep.Orders(f"{root}/table")


def keyed_orders(spark, sf):
    """One row per order from the keyed table."""
    return _upserted_orders(spark, sf).read(spark).select(
        "id", "order_status", "total_amount", "create_time", "operate_time", "consignee", "create_date")


def rollup_order_hour(spark, sf):
    """Orders and amount per hour as the job keeps them, of all days."""
    return _upserted_orders(spark, sf).per_hour(spark).select(
        "create_date", "create_hour", F.col("amount").cast("double").alias("amount"), "orders")


def stream_change_feed(spark, sf):
    """Change entries to order messages to the order table, read as a keyed store would."""
    root = work_folder(spark, "changes")
    bindings.change_entries(_table(spark, sf, "orders")).write.json(f"{root}/entries")
    jobs.forward_changes(changes.stream_entries(spark, f"{root}/entries"),
                         sinks.topic_folder(f"{root}/topics"), f"{root}/forwarded",
                         once=True).awaitTermination()
    jobs.ingest_orders(topics.read_folder(spark, f"{root}/topics", "order"), f"{root}/table",
                       partition="create_month", once=True).awaitTermination()
    return tables.read_orders(spark, f"{root}/table").select("id", "user_id", "total_amount", "create_date")


def stream_route_logs(spark, sf):
    """Messages by topic and by archived day, read back, and numbers per reason in quarantine."""
    root = work_folder(spark, "logs")
    lines = bindings.client_logs(_table(spark, sf, "events"))
    replay.write_topic(lines.select(F.to_json(F.struct("value", "arrived")).alias("value")),
                       f"{root}/incoming", "lines")
    arrived = F.from_json("value", "value string, arrived long")
    stream = (topics.read_folder(spark, f"{root}/incoming", "lines")
              .select(arrived.alias("l")).select("l.*"))
    jobs.route_logs(stream, sinks.topic_folder(f"{root}/topics"), f"{root}/archive",
                    now=F.col("arrived"), once=True).awaitTermination()
    archive = spark.read.schema("value string, log_date string").text(f"{root}/archive")
    rejected = tables.read_table(spark, f"{root}/archive/_quarantine", schemas.QUARANTINE_TABLE)
    fields = F.from_json("value", "event_id long, mid string, ts long, extra struct<amount: double>").alias("f")
    body = lambda rows, sink, part: rows.select(
        F.lit(sink).alias("sink"), F.col(part).alias("part"), fields).select(
        "sink", "part", "f.event_id", "f.mid", "f.ts", F.col("f.extra.amount").alias("amount"))
    bad = rejected.groupBy(F.col("_error").alias("part")).agg(F.count("*").alias("event_id"))
    return (body(topics.read_folder_once(spark, f"{root}/topics"), "topic", "topic")
            .unionByName(body(archive, "archive", "log_date"))
            .unionByName(bad.withColumn("sink", F.lit("quarantine")), allowMissingColumns=True))


def stream_alerts(spark, sf):
    root = work_folder(spark, "alerts")
    job = CouponAlertJob(f"{root}/job", LIVE, keep_s=3600)
    lines = _behaviour(spark, sf)
    batches = []

    def run():
        query = job.start(topics.read_folder(spark, f"{root}/topics", "event"), once=True)
        query.awaitTermination()
        batches.append(query.lastProgress["batchId"])

    replay.feed_in_time_order(
        lines, "ts", SLICES,
        lambda part: replay.write_topic(bindings.as_json(part), f"{root}/topics", "event"), run)
    job.close(spark, batches[-1])
    return job.alerts(spark).select(
        "alert_id", "mid", (F.col("ts") / 1000).cast("long").alias("w_end"), "kind", "name",
        "copies", "n_uids", "n_items", "n_events")


# -- sale details and regions -----------------------------------------------------------

def _found(spark, sf, keyword):
    orders = bindings.between_days(_table(spark, sf, "orders"), "o_orderdate", ORDER_DAY, ORDER_DAY)
    details = bindings.sale_details(_table(spark, sf, "lineitem"), orders,
                                    _table(spark, sf, "customer"), _table(spark, sf, "part"))
    return sale_detail.search(details, ORDER_DAY, keyword)


def sale_detail_page(spark, sf):
    return sale_detail.page(_found(spark, sf, None), offset=5, size=10)


def sale_detail_next_page(spark, sf):
    found = _found(spark, sf, None)
    last = found.orderBy("order_detail_id").offset(4).limit(1).first()
    return sale_detail.page_after(found, last["order_detail_id"], size=10) if last else found.limit(0)


def sale_detail_json(spark, sf):
    """The document, read back into rows: total, facet options and details."""
    found = _found(spark, sf, KEYWORD)
    fields = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in found.schema.fields)
    shape = f"total long, stat array<struct<facet:string,options:array<struct<name:string,value:long>>>>, detail array<struct<{fields}>>"
    doc = sale_detail.result_json(found, offset=0, size=10).select(F.from_json("json", shape).alias("d")).select("d.*")
    options = doc.select("total", F.inline("stat")).select("total", "facet", F.explode_outer("options").alias("o"))
    facets = options.select("total", "facet", F.col("o.name").alias("name"), F.col("o.value").alias("value"))
    rows = doc.select("total", F.explode("detail").alias("r")).select(
        "total", F.lit("detail").alias("facet"), F.col("r.order_detail_id").alias("name"), F.col("r.sku_id").alias("value"))
    return facets.unionByName(rows)


def sale_detail_keyword(spark, sf):
    return _found(spark, sf, KEYWORD.upper())


def sale_detail_total(spark, sf):
    return sale_detail.total(_found(spark, sf, KEYWORD))


def sale_detail_facets(spark, sf):
    return sale_detail.facets(_found(spark, sf, None))


def _detail_store(spark, sf):
    """All details of the tables, in a store of their own."""
    details = bindings.sale_details(*(_table(spark, sf, t) for t in ("lineitem", "orders", "customer", "part")))
    store = DetailStore(work_folder(spark, "details"), details.schema)
    store.load(details)
    return store


def stored_detail_keyword(spark, sf):
    return _detail_store(spark, sf).search(spark, ORDER_DAY, ITEM.upper())


def stored_detail_total(spark, sf):
    """Hits of a long keyword, of one letter, and of none, from counts alone."""
    store = _detail_store(spark, sf)
    return store.total(spark, ORDER_DAY, ITEM).union(store.total(spark, ORDER_DAY, ITEM[:1])).union(
        store.total(spark, ORDER_DAY))


def stored_detail_page(spark, sf):
    return _detail_store(spark, sf).page(spark, ORDER_DAY, offset=5, size=10)


def region_sales(spark, sf):
    return regions.region_sales(_table(spark, sf, "orders"), _table(spark, sf, "customer"),
                                _table(spark, sf, "nation"), unit=1e6)


QUERIES = [
    startup_decode_dates, event_decode, order_decode_mask, order_quarantine, log_route,
    change_feed_inserts, first_launch_batch, first_launch_unseen,
    dau_day, dau_empty_day, dau_hour, new_devices_day,
    order_amount_day, order_amount_empty_day, order_amount_hour,
    realtime_total, realtime_total_json, realtime_hour_dau, realtime_hour_amount,
    realtime_hour_map, realtime_hour_json,
    stored_dau_hour, stored_order_amount_hour, stored_realtime_total,
    coupon_alert_windows, coupon_alert_windows_live, coupon_alert_minute,
    stream_first_launch, stream_first_launch_exact, stream_orders,
    stream_orders_upsert, stream_first_launch_late, stream_counters, stream_first_days, keyed_orders, rollup_order_hour, stream_change_feed,
    stream_route_logs, stream_alerts,
    sale_detail_page, sale_detail_next_page, sale_detail_keyword, sale_detail_total, sale_detail_facets,
    sale_detail_json, stored_detail_keyword, stored_detail_total, stored_detail_page, region_sales, startup_quarantine, change_quarantine,
]


def _in_utc(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        default_work_root(spark)
        return query(spark, str(sf_dir).rstrip("/"))
    run.__name__ = query.__name__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in QUERIES} | (llm_queries.QUERIES if llm_queries else {})
    return {name: _in_utc(q) for name, q in found.items()}


def entry(spark: SparkSession) -> DataFrame:
    """Active devices per hour of one day."""
    return queries()["dau_hour"](spark, "/root/testdata/sf0.001")


# -- oracle -----------------------------------------------------------------------------

_START = """start_log AS (
  SELECT event_id, 'mid_' || user_id AS mid, epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events)"""

_FIRST = _START + """, launch AS (
  SELECT mid, log_date, log_hour, event_id, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn
    FROM start_log) WHERE rn = 1)"""

_PICK = lambda values, key: f"list_extract({values!r}, ({key} % {len(values)} + 1)::INTEGER)"

_STARTUP_FIELDS = f"""event_id, 'mid_' || user_id AS mid, user_id::VARCHAR AS uid, '{bindings.APP_ID}' AS appid,
  {_PICK(bindings.AREAS, 'event_id')} AS area, {_PICK(bindings.SYSTEMS, 'event_id')} AS os,
  CASE WHEN event_id % 2 = 0 THEN '{bindings.IOS_CHANNEL}' ELSE {_PICK(bindings.CHANNELS, 'event_id')} END AS ch,
  'startup' AS type, {_PICK(bindings.VERSIONS, 'event_id')} AS vs, epoch_us(ts) // 1000 AS ts,
  strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour"""

_ORDER_FIELDS = """SELECT o_orderkey::VARCHAR AS id, c_nationkey::VARCHAR AS province_id, c_name AS consignee,
  NULL::VARCHAR AS order_comment, left('138' || lpad(o_custkey::VARCHAR, 8, '0'), 3) || repeat('*', 8) AS consignee_tel,
  o_orderstatus AS order_status, NULL::VARCHAR AS payment_way, o_custkey::VARCHAR AS user_id, NULL::VARCHAR AS img_url,
  o_totalprice::DECIMAL(18,2)::DOUBLE AS total_amount, NULL::VARCHAR AS expire_time, NULL::VARCHAR AS delivery_address,
  strftime(o_orderdate, '%Y-%m-%d ') || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':00:00' AS create_time,
  NULL::VARCHAR AS operate_time, NULL::VARCHAR AS tracking_no, NULL::VARCHAR AS parent_order_id,
  NULL::VARCHAR AS out_trade_no, NULL::VARCHAR AS trade_body, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
  lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS create_hour
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""

_UPSERTED = f"""SELECT id, CASE WHEN id::BIGINT % 3 = 0 THEN 'X' ELSE order_status END AS order_status,
              CASE WHEN id::BIGINT % 3 = 0 THEN 1.0::DOUBLE ELSE total_amount END AS total_amount, create_time,
              CASE WHEN id::BIGINT % 3 = 0 THEN strftime(create_time::TIMESTAMP + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
                   ELSE create_time END AS operate_time, consignee, create_date FROM ({_ORDER_FIELDS})"""

_ORDER = """order_row AS (
  SELECT o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS user_id, o_orderstatus,
         '138********' AS consignee_tel,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS create_hour,
         o_totalprice::DECIMAL(18,2)::DOUBLE AS total_amount,
         o_totalprice::DECIMAL(18,2) AS cents, o_orderkey AS k
  FROM orders)"""

_BEHAVIOUR = """act AS (
  SELECT event_id, 'mid_' || (user_id % 5) AS mid, user_id::VARCHAR AS uid,
         (event_id % 50)::VARCHAR AS itemid, epoch_us(ts) // 1000 AS ts, ts AS seen_at,
         CASE event_type WHEN 'click' THEN 'clickItem' WHEN 'purchase' THEN 'coupon'
              WHEN 'signup' THEN 'coupon' WHEN 'view' THEN 'addCart'
              WHEN 'error' THEN 'addComment' END AS evid
  FROM events)"""


def _alert_sql(rule: AlertRule, per_minute: bool) -> str:
    """Header and member rows of every window that raises an alert, or of each minute's last."""
    panes, slide = rule.panes, rule.slide_s
    last = "QUALIFY row_number() OVER (PARTITION BY mid, w_end // 60 ORDER BY w_end DESC) = 1" if per_minute else ""
    return f"""WITH {_BEHAVIOUR}, placed AS (
  SELECT *, unnest(generate_series(ts // {slide * 1000}, ts // {slide * 1000} + {panes - 1})) AS w
  FROM act), alert AS (
  SELECT mid, w, ((w + 1) * {slide})::BIGINT AS w_end,
         count(DISTINCT uid) FILTER (evid = 'coupon') AS n_uids,
         count(DISTINCT itemid) FILTER (evid = 'coupon') AS n_items, count(evid) AS n_events
  FROM placed GROUP BY mid, w
  HAVING count(DISTINCT uid) FILTER (evid = 'coupon') >= {rule.min_uids}
     AND NOT bool_or(evid = 'clickItem')), kept AS (
  SELECT *, mid || '_' || (w_end // 60) AS alert_id FROM alert {last}), inside AS (
  SELECT k.alert_id, k.mid, k.w_end, p.uid, p.itemid, p.evid
  FROM kept k JOIN placed p ON p.mid = k.mid AND p.w = k.w), member AS (
  SELECT alert_id, mid, w_end, 'uid' AS kind, uid AS name FROM inside WHERE evid = 'coupon'
  UNION ALL SELECT alert_id, mid, w_end, 'item', itemid FROM inside WHERE evid = 'coupon'
  UNION ALL SELECT alert_id, mid, w_end, 'event', evid FROM inside)
SELECT alert_id, mid, w_end, kind, name, count(*) AS copies,
       NULL::BIGINT AS n_uids, NULL::BIGINT AS n_items, NULL::BIGINT AS n_events
FROM member GROUP BY alert_id, mid, w_end, kind, name
UNION ALL SELECT alert_id, mid, w_end, 'alert', NULL, NULL, n_uids, n_items, n_events FROM kept"""


_DETAIL = f"""detail AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS order_detail_id,
         o_orderkey AS order_id, o_custkey AS user_id, p_partkey AS sku_id,
         c_mktsegment AS user_gender, p_size AS user_age, (o_custkey % 5)::INTEGER AS user_level,
         p_retailprice AS sku_price, p_name AS sku_name, p_brand AS sku_tm_id,
         strftime(o_orderdate, '%Y-%m-%d') AS dt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
  WHERE strftime(o_orderdate, '%Y-%m-%d') = '{ORDER_DAY}')"""


def _amount(day: str) -> str:
    return f"(SELECT sum(cents)::DOUBLE FROM order_row WHERE create_date = '{day}')"


_NEW = f"""(SELECT count(*) FROM (SELECT mid FROM start_log GROUP BY mid
                                HAVING min(log_date) = '{LOG_DAY}'))"""
_DAU = f"(SELECT count(*) FROM launch WHERE log_date = '{LOG_DAY}')"
_HOURS = "(SELECT lpad(h::VARCHAR, 2, '0') AS hour FROM range(24) t(h))"


def _axis(rows: str, day_column: str, hour_column: str, value: str, day: str, before: str,
          zero: str) -> str:
    side = lambda d: f"""(SELECT {hour_column} AS hour, {value} AS v FROM {rows}
                         WHERE {day_column} = '{d}' GROUP BY 1)"""  # noqa: E731
    return f"""SELECT a.hour, coalesce(y.v, {zero}) AS yesterday, coalesce(t.v, {zero}) AS today
      FROM {_HOURS} a LEFT JOIN {side(before)} y ON a.hour = y.hour
                      LEFT JOIN {side(day)} t ON a.hour = t.hour"""


def _series(day: str) -> str:
    return f"""(SELECT string_agg(create_hour || '=' || v::VARCHAR, ',' ORDER BY create_hour)
      FROM (SELECT create_hour, sum(cents)::DECIMAL(18,2) AS v FROM order_row
            WHERE create_date = '{day}' GROUP BY 1))"""


def _dau_json(day: str) -> str:
    return f"""coalesce((SELECT string_agg('"' || log_hour || '":' || n, ',' ORDER BY log_hour)
      FROM (SELECT log_hour, count(*) AS n FROM launch WHERE log_date = '{day}' GROUP BY 1)), '')"""


def oracle_sql() -> dict[str, str]:
    return _sql() | (llm_queries.ORACLE_SQL if llm_queries else {})


def _sql() -> dict[str, str]:
    label = schemas.METRIC_LABELS
    routed = """SELECT *, CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END AS topic
                FROM events WHERE event_id % 97 <> 0"""
    inserted = """k % 100 <> 50 AND k % 10 <> 9 AND o_orderstatus <> 'P'"""
    return {
        "startup_decode_dates":
            f"SELECT {_STARTUP_FIELDS} FROM events",
        "event_decode": f"""WITH {_BEHAVIOUR}
            SELECT event_id, mid, uid, '{bindings.APP_ID}' AS appid, {_PICK(bindings.AREAS, 'event_id')} AS area,
                   {_PICK(bindings.SYSTEMS, 'event_id')} AS os, NULL::VARCHAR AS ch, 'event' AS type, evid,
                   (event_id % 7)::VARCHAR AS pgid, (event_id % 11)::VARCHAR AS npgid, itemid, ts,
                   strftime(seen_at, '%Y-%m-%d') AS log_date, strftime(seen_at, '%H') AS log_hour
            FROM act""",
        "order_decode_mask": _ORDER_FIELDS,
        "order_quarantine": """SELECT error, count(*) AS n FROM (
              SELECT CASE WHEN o_orderkey % 53 = 0 THEN 'bad_json'
                          WHEN o_orderkey % 41 = 0 THEN 'bad_total_amount'
                          WHEN o_orderkey % 43 = 0 THEN 'missing_consignee_tel'
                          WHEN o_orderkey % 47 = 0 THEN 'bad_create_time' END AS error FROM orders)
            WHERE error IS NOT NULL GROUP BY error""",
        "startup_quarantine": """SELECT error, count(*) AS n FROM (
              SELECT CASE WHEN event_id % 37 = 0 THEN 'bad_json' WHEN event_id % 41 = 0 THEN 'missing_mid'
                          WHEN event_id % 43 = 0 THEN 'bad_ts' WHEN event_id % 47 = 0 THEN 'missing_ts' END AS error
              FROM events) WHERE error IS NOT NULL GROUP BY error""",
        "change_quarantine": """SELECT error, count(*) AS n FROM (
              SELECT CASE WHEN o_orderkey % 59 = 0 THEN 'bad_json' WHEN o_orderkey % 61 = 0 THEN 'missing_table' END AS error
              FROM orders) WHERE error IS NOT NULL GROUP BY error""",
        "log_route": f"""SELECT event_id, topic, epoch_us(ts) // 1000 AS ts, value AS amount
            FROM ({routed})""",
        "change_feed_inserts": f"""WITH {_ORDER}
            SELECT id, user_id, total_amount, create_date FROM order_row WHERE {inserted}""",
        "first_launch_batch": f"WITH {_FIRST} SELECT mid, log_date, log_hour, event_id, ts FROM launch",
        "first_launch_unseen": f"""WITH {_START}
            SELECT event_id, mid, log_date FROM start_log a WHERE log_hour >= '12' AND NOT EXISTS (
              SELECT 1 FROM start_log b
              WHERE b.mid = a.mid AND b.log_date = a.log_date AND b.log_hour < '12')""",
        "dau_day": f"WITH {_FIRST} SELECT {_DAU} AS ct",
        "dau_empty_day":
            f"WITH {_FIRST} SELECT count(*) AS ct FROM launch WHERE log_date = '{EMPTY_DAY}'",
        "dau_hour": f"""WITH {_FIRST} SELECT log_hour, count(*) AS ct FROM launch
            WHERE log_date = '{LOG_DAY}' GROUP BY log_hour""",
        "new_devices_day": f"WITH {_START} SELECT {_NEW} AS ct",
        "order_amount_day": f"WITH {_ORDER} SELECT {_amount(ORDER_DAY)} AS order_amount",
        "order_amount_empty_day": f"WITH {_ORDER} SELECT {_amount(EMPTY_DAY)} AS order_amount",
        "order_amount_hour": f"""WITH {_ORDER}
            SELECT create_hour, sum(cents)::DOUBLE AS order_amount FROM order_row
            WHERE create_date = '{ORDER_DAY}' GROUP BY create_hour""",
        "realtime_total": f"""WITH {_FIRST}, {_ORDER}
            SELECT 1::INTEGER AS ord, 'dau' AS id, '{label["dau"]}' AS name, {_DAU}::DOUBLE AS value
            UNION ALL SELECT 2, 'new_mid', '{label["new_mid"]}', {_NEW}::DOUBLE
            UNION ALL SELECT 3, 'order_amount', '{label["order_amount"]}', {_amount(ORDER_DAY)}""",
        "realtime_total_json": f"""WITH {_FIRST}
            SELECT '[{{"id":"dau","name":"{label["dau"]}","value":' || {_DAU}
              || '}},{{"id":"new_mid","name":"{label["new_mid"]}","value":' || {_NEW}
              || '}},{{"id":"order_amount","name":"{label["order_amount"]}"}}]' AS json""",
        "stored_dau_hour": f"""WITH {_FIRST} SELECT log_hour, count(*) AS ct FROM launch
            WHERE log_date = '{LOG_DAY}' GROUP BY log_hour""",
        "stored_order_amount_hour": f"""WITH {_ORDER}
            SELECT create_hour, sum(cents)::DOUBLE AS order_amount FROM order_row
            WHERE create_date = '{ORDER_DAY}' GROUP BY create_hour""",
        "stored_realtime_total": f"""WITH {_FIRST}, {_ORDER}
            SELECT 1::INTEGER AS ord, 'dau' AS id, '{label["dau"]}' AS name, {_DAU}::DOUBLE AS value
            UNION ALL SELECT 2, 'new_mid', '{label["new_mid"]}', {_NEW}::DOUBLE
            UNION ALL SELECT 3, 'order_amount', '{label["order_amount"]}', {_amount(ORDER_DAY)}""",
        "realtime_hour_dau": f"WITH {_FIRST} " + _axis(
            "launch", "log_date", "log_hour", "count(*)::BIGINT", LOG_DAY, LOG_DAY_BEFORE, "0"),
        "realtime_hour_amount": f"WITH {_ORDER} " + _axis(
            "order_row", "create_date", "create_hour", "sum(cents)::DOUBLE",
            ORDER_DAY, ORDER_DAY_BEFORE, "0.0::DOUBLE"),
        "realtime_hour_map": f"""WITH {_ORDER}
            SELECT 'yesterday' AS day_label, coalesce({_series(ORDER_DAY_BEFORE)}, '') AS series
            UNION ALL SELECT 'today', coalesce({_series(ORDER_DAY)}, '')""",
        "realtime_hour_json": f"""WITH {_FIRST}
            SELECT '{{"yesterday":{{' || {_dau_json(LOG_DAY_BEFORE)}
              || '}},"today":{{' || {_dau_json(LOG_DAY)} || '}}}}' AS json""",
        "coupon_alert_windows": _alert_sql(BROAD, False),
        "coupon_alert_windows_live": _alert_sql(LIVE, False),
        "coupon_alert_minute": _alert_sql(LIVE, True),
        "stream_first_launch": f"WITH {_START} SELECT DISTINCT mid, log_date FROM start_log",
        "stream_first_launch_exact": f"WITH {_FIRST} SELECT mid, log_date, event_id FROM launch",
        "stream_orders": _ORDER_FIELDS,
        "stream_orders_upsert": _UPSERTED,
        "keyed_orders": _UPSERTED,
        "rollup_order_hour": f"""SELECT create_date, create_hour, sum(total_amount::DECIMAL(18,2))::DOUBLE AS amount,
              count(*) AS orders FROM (SELECT u.*, lpad((id::BIGINT % 24)::VARCHAR, 2, '0') AS create_hour FROM ({_UPSERTED}) u)
            GROUP BY create_date, create_hour""",
        "stream_first_launch_late": f"WITH {_START} SELECT DISTINCT mid, log_date FROM start_log",
        "stream_counters": f"""WITH {_START}, cut AS (
              SELECT *, (ts - min(ts) OVER ()) // ((max(ts) OVER () - min(ts) OVER ()) // {SLICES} + 1) AS batch FROM start_log)
            SELECT 'rows' AS counter, batch::BIGINT AS batch, count(*) AS n FROM cut GROUP BY batch
            UNION ALL SELECT 'rejected', batch::BIGINT, 0 FROM cut GROUP BY batch
            UNION ALL SELECT 'kept', batch::BIGINT, count(*) FROM (
              SELECT mid, log_date, min(batch) AS batch FROM cut GROUP BY mid, log_date) GROUP BY batch""",
        "stream_first_days": f"WITH {_START} SELECT mid, min(log_date) AS first_day FROM start_log GROUP BY mid",
        "stream_change_feed": f"""WITH {_ORDER}
            SELECT id, user_id, total_amount, create_date FROM order_row WHERE {inserted}""",
        "stream_route_logs": f"""WITH routed AS (SELECT *, 'mid_' || user_id AS mid, epoch_us(ts) // 1000 AS ms FROM ({routed}))
            SELECT 'topic' AS sink, topic AS part, event_id, mid, ms AS ts, value AS amount FROM routed
            UNION ALL SELECT 'archive', strftime(ts, '%Y-%m-%d'), event_id, mid, ms, value FROM routed
            UNION ALL SELECT 'quarantine', 'bad_json', count(*), NULL, NULL, NULL FROM events
                      WHERE event_id % 97 = 0 HAVING count(*) > 0""",
        "stream_alerts": _alert_sql(LIVE, True),
        "sale_detail_page":
            f"WITH {_DETAIL} SELECT * FROM detail ORDER BY order_detail_id LIMIT 10 OFFSET 5",
        "sale_detail_next_page":
            f"WITH {_DETAIL} SELECT * FROM detail ORDER BY order_detail_id LIMIT 10 OFFSET 5",
        "sale_detail_json": f"""WITH {_DETAIL}, hit AS (
              SELECT * FROM detail WHERE contains(lower(sku_name), '{KEYWORD}')), t AS (SELECT count(*) AS total FROM hit),
            member AS (
              SELECT 'age' AS facet, CASE WHEN user_age < 20 THEN '<20'
                     WHEN user_age <= 30 THEN '20-30' ELSE '>30' END AS name FROM hit
              UNION ALL SELECT 'gender', user_gender FROM hit),
            counted AS (SELECT facet, name, count(*) AS value FROM member GROUP BY facet, name
              UNION ALL SELECT f, NULL, NULL FROM (VALUES ('age'), ('gender')) v(f) WHERE (SELECT total FROM t) = 0)
            SELECT total, facet, name, value FROM t, counted
            UNION ALL SELECT total, 'detail', order_detail_id, sku_id::BIGINT FROM t,
              (SELECT * FROM hit ORDER BY order_detail_id LIMIT 10)""",
        "sale_detail_keyword":
            f"WITH {_DETAIL} SELECT * FROM detail WHERE contains(lower(sku_name), '{KEYWORD}')",
        "sale_detail_total": f"""WITH {_DETAIL} SELECT count(*) AS total FROM detail
            WHERE contains(lower(sku_name), '{KEYWORD}')""",
        "sale_detail_facets": f"""WITH {_DETAIL}, member AS (
              SELECT 'age' AS facet, CASE WHEN user_age < 20 THEN '<20'
                     WHEN user_age <= 30 THEN '20-30' ELSE '>30' END AS value FROM detail
              UNION ALL SELECT 'gender', user_gender FROM detail)
            SELECT facet, value, n, n::DOUBLE / sum(n) OVER (PARTITION BY facet) AS share FROM (
              SELECT facet, value, count(*) AS n FROM member GROUP BY facet, value)""",
        "stored_detail_keyword":
            f"WITH {_DETAIL} SELECT * FROM detail WHERE contains(lower(sku_name), '{ITEM}')",
        "stored_detail_total": f"""WITH {_DETAIL}
            SELECT count(*) AS total FROM detail WHERE contains(lower(sku_name), '{ITEM}')
            UNION ALL SELECT count(*) FROM detail WHERE contains(lower(sku_name), '{ITEM[:1]}')
            UNION ALL SELECT count(*) FROM detail""",
        "stored_detail_page":
            f"WITH {_DETAIL} SELECT * FROM detail ORDER BY order_detail_id LIMIT 10 OFFSET 5",
        "region_sales": """SELECT region, amount,
              CASE WHEN amount < 0 THEN 0 WHEN amount / 1e6 >= 600 THEN 7
                   ELSE floor(amount / 1e6 / 100) + 1 END::BIGINT AS band
            FROM (SELECT n_name AS region, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS amount
                  FROM orders JOIN customer ON o_custkey = c_custkey
                       JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)""",
    }
