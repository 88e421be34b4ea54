"""Server stamp and topic of client log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse import schemas
from storepulse.functions import text, times


def _now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def stamp_and_route(logs: DataFrame, value: str = "value", now: Column | None = None,
                    startup_topic: str = schemas.TOPIC_STARTUP,
                    event_topic: str = schemas.TOPIC_EVENT) -> DataFrame:
    """`topic`, stamped `value`, `ts`, `log_date` and `_error` of every line.

    The log is an open record: fields no schema knows pass through unchanged as
    variants. A client's own `ts` is replaced. Every line whose type is not
    `startup`, also one without a type, is an event. `now` is the stamping time
    in epoch milliseconds, for replays.
    """
    stamp = _now_ms() if now is None else now
    fields = F.map_entries(F.from_json(F.col(value), "map<string,variant>"))
    # A generator parses each line once; see decode_json.
    read = logs.select(F.col(value).alias("_raw"), stamp.alias("ts"),
                       F.explode(F.array(fields)).alias("_all"))
    read = read.select("_raw", "ts", text.last_entry_wins(F.col("_all"), "key").alias("_f"))
    others = F.filter("_f", lambda e: e["key"] != "ts")
    stamped = F.map_from_entries(F.concat(others, F.array(
        F.struct(F.lit("ts").alias("key"), F.col("ts").cast("variant").alias("value")))))
    place = F.array_position(F.col("_f")["key"], "type").cast("int") - 1
    kind = F.try_variant_get(F.get(F.col("_f")["value"], place), "$", "string")
    return read.select(
        F.when(kind == "startup", startup_topic).otherwise(event_topic).alias("topic"),
        F.to_json(stamped).alias("value"),
        "ts",
        times.log_date(F.col("ts")).alias("log_date"),
        "_raw",
        F.when(F.col("_f").isNull(), F.lit("bad_json")).alias("_error"),
    )
