"""Dates, hours and minutes of log and order times.

Epoch values are milliseconds. Days follow `spark.sql.session.timeZone`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
#: The end of the year 9999: later times have no four-digit date.
LAST_MS = 253_402_300_799_999


def usable_ms(ts: Column) -> Column:
    """Whether a time lies in the years 1970 to 9999; null for null."""
    return ts.between(0, LAST_MS)


def instant(ts: Column) -> Column:
    """The timestamp of an epoch value, null where there is none; never fails."""
    return F.when(usable_ms(ts), F.timestamp_millis(ts))


def log_date(ts: Column) -> Column:
    return F.to_date(instant(ts)).cast("string")


def log_hour(ts: Column) -> Column:
    return F.lpad(F.hour(instant(ts)).cast("string"), 2, "0")


def create_date(create_time: Column) -> Column:
    """The text before the first space; no date is parsed."""
    return F.get(F.split(create_time, " "), F.lit(0))


def create_hour(create_time: Column) -> Column:
    """The text between the first space and the next colon, null if there is no time part."""
    clock = F.get(F.split(F.rtrim(create_time), " "), F.lit(1))
    return F.get(F.split(clock, ":"), F.lit(0))


def previous_day(day: Column) -> Column:
    """The day before a `yyyy-MM-dd` string; null when it is no date."""
    parsed = F.to_date(F.try_to_timestamp(day, F.lit("yyyy-M-d")))
    return F.date_format(F.date_add(parsed, -1), DAY)


def today() -> Column:
    return F.date_format(F.current_date(), DAY)


def div(value: Column, step: int) -> Column:
    """Floor division of a long, right for negative values too."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step)).cast("long")


def minute_of(seconds: Column) -> Column:
    return div(seconds, 60)


def alert_id(mid: Column, seconds: Column) -> Column:
    """Device and minute: the document key that limits alerts to one a minute."""
    return F.concat_ws("_", mid, minute_of(seconds).cast("string"))
