"""Record types, topic names and metric names."""

from __future__ import annotations

from pyspark.sql import types as T


def _record(strings: str, **typed: T.DataType) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in strings.split()]
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in typed.items()])


# What a log line or an order message carries; derived columns come later.
STARTUP = _record("mid uid appid area os ch type vs", ts=T.LongType())
EVENT = _record("mid uid appid area os ch type evid pgid npgid itemid", ts=T.LongType())
ORDER = _record(
    "id province_id consignee order_comment consignee_tel order_status payment_way"
    " user_id img_url expire_time delivery_address create_time operate_time tracking_no"
    " parent_order_id out_trade_no trade_body",
    total_amount=T.DoubleType(),
)

# Serving tables: the columns that are stored, in stored order.
FIRST_LAUNCH_COLUMNS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs",
                        "log_date", "log_hour", "ts"]
ORDER_COLUMNS = ["id", "province_id", "consignee", "order_comment", "consignee_tel",
                 "order_status", "payment_way", "user_id", "img_url", "total_amount",
                 "expire_time", "delivery_address", "create_time", "operate_time",
                 "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
                 "create_date", "create_hour"]

FIRST_LAUNCH_TABLE = T.StructType(
    [T.StructField(c, T.LongType() if c == "ts" else T.StringType()) for c in FIRST_LAUNCH_COLUMNS])
ORDER_TABLE = T.StructType(
    [T.StructField(c, T.DoubleType() if c == "total_amount" else T.StringType())
     for c in ORDER_COLUMNS])
QUARANTINE_TABLE = T.StructType(
    [T.StructField("_raw", T.StringType()), T.StructField("_error", T.StringType())])

# One change-feed entry: a statement on one table and the after-image of its rows.
_CELL = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])
_ROW = T.StructType([T.StructField("after", T.ArrayType(_CELL))])
CHANGE = T.StructType([
    T.StructField("entry_type", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("rows", T.ArrayType(_ROW)),
])

# Facts of one slide-wide pane of the alert stream, and the alerts: a header row each, and its members.
PANE_FACTS = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("pane", T.LongType()),
    T.StructField("evid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("itemid", T.StringType()),
    T.StructField("n", T.LongType()),
])
ALERT_TABLE = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("mid", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("copies", T.LongType()),
    T.StructField("n_uids", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("n_events", T.LongType()),
    T.StructField("withdrawn", T.BooleanType()),
])

TOPIC_STARTUP = "startup"
TOPIC_EVENT = "event"
TOPIC_ORDER = "order"

METRIC_DAU = "dau"
METRIC_NEW_MID = "new_mid"
METRIC_ORDER_AMOUNT = "order_amount"

# The labels the dashboard shows beside each total.
METRIC_LABELS = {
    METRIC_DAU: "新增日活",
    METRIC_NEW_MID: "新增日活",
    METRIC_ORDER_AMOUNT: "新增交易额",
}
