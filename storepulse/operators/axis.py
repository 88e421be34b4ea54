"""The 24-hour axis and two days side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse.functions import times

TODAY, YESTERDAY = "today", "yesterday"


def day_pair(rows: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of a day and of the day before it, marked in `day_label`; one scan for both."""
    before = times.previous_day(F.lit(day))
    return (rows.filter((F.col(column) == day) | (F.col(column) == before))
            .withColumn("day_label", F.when(F.col(column) == day, TODAY).otherwise(YESTERDAY)))


def hours_of_day(like: DataFrame) -> DataFrame:
    """`hour` 00 .. 23; `like` only lends its session."""
    return like.sparkSession.range(24).select(
        F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def fill_hours(per_hour: DataFrame, *values: str, zero: Column | None = None) -> DataFrame:
    """All 24 hours in turn, with 0 where `per_hour` (one row per hour) has no value."""
    zero = F.lit(0) if zero is None else zero
    filled = [F.coalesce(F.col(v), zero).alias(v) for v in values]
    return hours_of_day(per_hour).join(per_hour, "hour", "left").select("hour", *filled)


def map_of_hours(hour: Column, value: Column, only: Column) -> Column:
    """Aggregate: map from hour to value of the rows where `only` holds, in hour order."""
    return F.map_from_entries(F.sort_array(F.collect_list(F.when(only, F.struct(hour, value)))))
