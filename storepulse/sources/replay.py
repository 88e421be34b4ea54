"""Bounded tables laid down as topic folders, so that streams can be replayed on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_topic(messages: DataFrame, path: str, topic: str) -> None:
    """Append `value` lines to a topic folder."""
    (messages.select("value", F.lit(topic).alias("topic"))
     .write.mode("append").partitionBy("topic").text(path))


def feed_in_time_order(rows: DataFrame, time: str, slices: int,
                       write: Callable[[DataFrame], None],
                       after_each: Callable[[], None] = lambda: None) -> None:
    """Hand `rows` to `write` in equal spans of `time`, the earliest first.

    Run the stream in `after_each` to make every span one micro-batch; it then
    also restarts from its checkpoint each time. Only the smallest and largest
    time come to the driver.
    """
    low, high = rows.agg(F.min(time), F.max(time)).first()
    if low is None:
        return
    step = (high - low) // slices + 1
    for i in range(slices):
        write(rows.filter((F.col(time) >= low + i * step) & (F.col(time) < low + (i + 1) * step)))
        after_each()
