"""Daily totals and hourly series over the first-launch and order tables.

`dau` has one row per device and day (mid, log_date, log_hour); `orders` has
one row per order (create_date, create_hour, total_amount). When they are
tables partitioned by day, the day filters here read those partitions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse import schemas
from storepulse.functions import times
from storepulse.operators import axis

CENTS = "decimal(18,2)"


def _money(amount: str = "total_amount") -> Column:
    """An exact sum of two-digit amounts, null when there is none.

    Each amount is rounded to cents first (1.005 counts as 1.01); a sum of doubles would
    depend on the order of the rows. Amounts that do not fit were set aside by decoding.
    """
    return F.sum(F.col(amount).cast(CENTS)).cast("double")


def _is_day(column: str, day: str | None) -> Column:
    """Rows of a day; of today if none is given. Either way a constant, which prunes partitions."""
    return F.col(column) == (times.today() if day is None else F.lit(day))


def dau_total(dau: DataFrame, day: str | None = None) -> DataFrame:
    return dau.filter(_is_day("log_date", day)).agg(F.count("*").alias("ct"))


def dau_by_hour(dau: DataFrame, day: str | None = None) -> DataFrame:
    return dau.filter(_is_day("log_date", day)).groupBy("log_hour").agg(F.count("*").alias("ct"))


def order_amount(orders: DataFrame, day: str | None = None) -> DataFrame:
    return orders.filter(_is_day("create_date", day)).agg(_money().alias("order_amount"))


def order_amount_by_hour(orders: DataFrame, day: str | None = None) -> DataFrame:
    return (orders.filter(_is_day("create_date", day))
            .groupBy("create_hour").agg(_money().alias("order_amount")))


def new_devices(dau: DataFrame, day: str) -> DataFrame:
    """Devices whose first day of all is `day`.

    Days are compared as dates, so both levels of the aggregate stay in the
    hash map and a device sends one row per task.
    """
    first = (dau.filter(F.col("log_date") <= day)
             .groupBy("mid").agg(F.min(F.col("log_date").cast("date")).alias("first_day")))
    return (first.filter(F.col("first_day") == F.lit(day).cast("date"))
            .agg(F.count("*").alias("ct")))


def first_days(dau: DataFrame) -> DataFrame:
    """`mid`, `first_day` (text): the table that the launch job keeps beside the launches."""
    first = dau.groupBy("mid").agg(F.min(F.col("log_date").cast("date")).alias("first_day"))
    return first.select("mid", F.col("first_day").cast("string").alias("first_day"))


def new_devices_stored(days: DataFrame, day: str | None = None) -> DataFrame:
    """Devices whose first day is `day`, from a table of first days partitioned by them."""
    return days.filter(_is_day("first_day", day)).agg(F.count("*").alias("ct"))


def realtime_total(dau: DataFrame, orders: DataFrame, day: str,
                   history: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """The three totals in display order: `ord`, `id`, `name`, `value`.

    New devices are counted in `days` (mid, first_day) if given; else they are looked up in
    `history` (mid, log_date), by default `dau` itself.
    """
    new = (new_devices(dau if history is None else history, day) if days is None
           else new_devices_stored(days, day))
    totals = [
        (schemas.METRIC_DAU, dau_total(dau, day)),
        (schemas.METRIC_NEW_MID, new),
        (schemas.METRIC_ORDER_AMOUNT, order_amount(orders, day)),
    ]
    rows = None
    for place, (metric, total) in enumerate(totals, start=1):
        row = total.select(
            F.lit(place).alias("ord"), F.lit(metric).alias("id"),
            F.lit(schemas.METRIC_LABELS[metric]).alias("name"),
            F.col(total.columns[0]).cast("double").alias("value"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def realtime_total_json(dau: DataFrame, orders: DataFrame, day: str,
                        history: DataFrame | None = None) -> DataFrame:
    """The totals as one JSON array; counts are whole numbers, a missing amount has no value."""
    counted = F.col("id") != schemas.METRIC_ORDER_AMOUNT
    item = F.when(counted, F.to_json(F.struct("id", "name", F.col("value").cast("long").alias("value")))
                  ).otherwise(F.to_json(F.struct("id", "name", "value")))
    items = F.sort_array(F.collect_list(F.struct("ord", item.alias("item"))))
    return realtime_total(dau, orders, day, history).agg(
        F.concat(F.lit("["), F.array_join(F.transform(items, lambda i: i["item"]), ","), F.lit("]"))
        .alias("json"))


def _dau_series(dau: DataFrame, day: str) -> DataFrame:
    return (axis.day_pair(dau, "log_date", day)
            .groupBy("day_label", F.col("log_hour").alias("hour"))
            .agg(F.count("*").alias("value")))


def _order_series(orders: DataFrame, day: str) -> DataFrame:
    return (axis.day_pair(orders, "create_date", day)
            .groupBy("day_label", F.col("create_hour").alias("hour"))
            .agg(_money().alias("value")))


# Which table a series is computed from, and how.
HOURLY: dict[str, tuple[str, Callable[[DataFrame, str], DataFrame]]] = {
    schemas.METRIC_DAU: ("dau", _dau_series),
    schemas.METRIC_ORDER_AMOUNT: ("orders", _order_series),
}


def hourly_series(tables: dict[str, DataFrame], metric: str, day: str) -> DataFrame:
    """`day_label`, `hour`, `value` of a metric for a day and the day before.

    `tables` holds `dau` and `orders`. An unknown metric gives no rows.
    """
    if metric not in HOURLY:
        some = next(iter(tables.values())).sparkSession
        return some.createDataFrame([], "day_label string, hour string, value double")
    table, series = HOURLY[metric]
    return series(tables[table], day)


def realtime_hour(tables: dict[str, DataFrame], metric: str, day: str) -> DataFrame:
    """`hour`, `yesterday`, `today` on the full 24-hour axis, 0 where nothing happened."""
    series = hourly_series(tables, metric, day)
    side = lambda label: F.sum(F.when(F.col("day_label") == label, F.col("value"))).alias(label)
    per_hour = series.groupBy("hour").agg(side(axis.YESTERDAY), side(axis.TODAY))
    filled = axis.fill_hours(per_hour, axis.YESTERDAY, axis.TODAY)
    return filled if metric in HOURLY else filled.limit(0)


def realtime_hour_maps(tables: dict[str, DataFrame], metric: str, day: str) -> DataFrame:
    """One row: the hours that have values as maps `yesterday` and `today`."""
    series = hourly_series(tables, metric, day)
    of = lambda label: axis.map_of_hours(
        F.col("hour"), F.col("value"), F.col("day_label") == label).alias(label)
    maps = series.agg(of(axis.YESTERDAY), of(axis.TODAY))
    return maps if metric in HOURLY else maps.limit(0)


def realtime_hour_json(tables: dict[str, DataFrame], metric: str, day: str) -> DataFrame:
    """The maps as one JSON object; no row for an unknown metric."""
    return realtime_hour_maps(tables, metric, day).select(
        F.to_json(F.struct(axis.YESTERDAY, axis.TODAY)).alias("json"))
