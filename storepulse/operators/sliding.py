"""Sliding windows in which a device shows enough distinct members and no veto.

The windows of a device are decided without copying each event into every
window that covers it (60 copies at the default setting of 300 s every 5 s):

1. Time is cut into panes of one slide. A member seen in pane p is present in
   the `panes` windows that end with panes p .. p + panes - 1.
2. Per member, the presence intervals are cut so that they do not overlap; each
   then adds +1 where it starts and -1 where it ends.
3. These changes are summed per device and pane (combined on the map side), and
   a running sum gives, between two changes, the number of distinct members.

Intervals are clipped to buckets of fixed length. The running sum of a device
therefore never covers more rows than a bucket has panes, however many events
the device has; step 2 is spread over the members of the device.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storepulse.functions import times


@dataclass(frozen=True)
class AlertRule:
    """When a device is suspicious: many accounts took coupons and none looked at an item."""

    window_s: int = 300
    slide_s: int = 5
    min_uids: int = 3
    coupon: str = "coupon"
    click: str = "clickItem"
    bucket_s: int = 3600

    def __post_init__(self):
        if self.window_s <= 0 or self.slide_s <= 0 or self.window_s % self.slide_s:
            raise ValueError("the window must be a positive multiple of the slide")

    @property
    def panes(self) -> int:
        """Panes in one window."""
        return self.window_s // self.slide_s

    @property
    def bucket_panes(self) -> int:
        return max(self.bucket_s // self.slide_s, 4 * self.panes)


def with_pane(events: DataFrame, rule: AlertRule) -> DataFrame:
    return events.withColumn("pane", times.div(F.col("ts"), rule.slide_s * 1000))


def alert_spans(events: DataFrame, rule: AlertRule) -> DataFrame:
    """`mid`, `first`, `last`: the runs of window numbers that qualify.

    `events` needs mid, evid, uid and pane. Window w covers the panes
    w - panes + 1 .. w and ends `(w + 1) * slide_s` seconds after the epoch.
    """
    size = F.lit(rule.bucket_panes)
    signal = (events
              .filter(F.col("evid").isin(rule.coupon, rule.click))
              .select("mid", "pane", (F.col("evid") == rule.click).alias("veto"),
                      F.when(F.col("evid") == rule.coupon, F.col("uid")).alias("member"))
              .filter(F.col("veto") | F.col("member").isNotNull()))
    placed = signal.withColumn("bucket", F.explode(F.sequence(
        times.div(F.col("pane"), rule.bucket_panes),
        times.div(F.col("pane") + rule.panes - 1, rule.bucket_panes))))
    # Repeats of a pane need no step of their own: their interval comes out empty below.
    same = Window.partitionBy("mid", "veto", "member", "bucket").orderBy("pane")
    start = F.greatest("pane", F.col("bucket") * size, F.lag("pane").over(same) + rule.panes)
    end = F.least(F.col("pane") + rule.panes, (F.col("bucket") + 1) * size)
    present = (placed.select("mid", "veto", "bucket", start.alias("start"), end.alias("end"))
               .filter(F.col("start") < F.col("end")))

    changes = (present
               .select("mid", "veto", "bucket", F.explode(F.array(
                   F.struct(F.col("start").alias("at"), F.lit(1).alias("by")),
                   F.struct(F.col("end").alias("at"), F.lit(-1).alias("by")))).alias("c"))
               .groupBy("mid", "bucket", F.col("c.at").alias("at"))
               .agg(F.sum(F.when(~F.col("veto"), F.col("c.by")).otherwise(0)).alias("members"),
                    F.sum(F.when(F.col("veto"), F.col("c.by")).otherwise(0)).alias("vetoes")))

    ordered = Window.partitionBy("mid", "bucket").orderBy("at")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (changes
            .select("mid", F.col("at").alias("first"),
                    (F.coalesce(F.lead("at").over(ordered), F.col("at") + 1) - 1).alias("last"),
                    F.sum("members").over(so_far).alias("members"),
                    F.sum("vetoes").over(so_far).alias("vetoes"))
            .filter((F.col("members") >= rule.min_uids) & (F.col("vetoes") == 0))
            .select("mid", "first", "last"))


def span_windows(spans: DataFrame) -> DataFrame:
    """`mid`, `w`: every qualifying window."""
    return spans.select("mid", F.explode(F.sequence("first", "last")).alias("w"))


def window_end_s(w, rule: AlertRule):
    return (w + 1) * F.lit(rule.slide_s)


def last_window_per_minute(spans: DataFrame, rule: AlertRule) -> DataFrame:
    """`mid`, `minute`, `w`: of the qualifying windows that end in one minute, the last."""
    if rule.slide_s >= 60:
        windows = span_windows(spans).withColumn(
            "minute", times.minute_of(window_end_s(F.col("w"), rule)))
    else:
        minute_of = lambda w: times.minute_of(window_end_s(F.col(w), rule))
        last_in_minute = times.div(F.col("minute") * 60 + 59, rule.slide_s) - 1
        windows = (spans
                   .withColumn("minute", F.explode(F.sequence(minute_of("first"), minute_of("last"))))
                   .select("mid", "minute", F.least(F.col("last"), last_in_minute).alias("w")))
    return windows.groupBy("mid", "minute").agg(F.max("w").alias("w"))
