"""Coupon alerts on a stream of events.

A window is judged once the stream's clock has passed its end, as a windowed job judges it
at the tick. The clock is the newest event seen, or, with `clock`, real time as well: ticks of
a rate source come with the events, so that windows end although no event follows. Each batch

1. counts its events per pane,
2. judges, for all devices, the windows that have ended since the last batch,
   reading only the stretch of time those windows cover,
3. judges again the minutes that late events of this batch fall into, and
   withdraws alerts that no longer hold,
4. adds its panes to the ring of stored panes, which lets those go that are too old to matter.

The position of the clock and the ring are carried from batch to batch. Both are read as of
the batch before, and all writes are keyed by the batch, so a crash repeats at most one batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storepulse import schemas
from storepulse.functions import times
from storepulse.operators import alerts, decode
from storepulse.operators.sliding import (
    AlertRule, alert_spans, last_window_per_minute, window_end_s)
from storepulse.sources import tables
from storepulse.sources.keyed import KeyedTable
from storepulse.streaming import sinks

_CLOCK = T.StructType([T.StructField(c, T.LongType()) for c in ("batch_id", "closed", "newest")])


@dataclass(frozen=True)
class CouponAlertJob:
    """`path` holds the alerts, the ring of panes, the clock and the checkpoint.

    `wait_s` keeps windows open for that long after their end, for events out of order.
    `keep_s` is how far behind the clock an event may come and still count: older ones go to
    `_quarantine` as too late, and panes that no such event can concern are let go. Without
    it every pane is kept and events count however late.
    """

    path: str
    rule: AlertRule = field(default_factory=AlertRule)
    wait_s: int = 0
    keep_s: int | None = None

    @property
    def ring(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/ring", schemas.PANE_FACTS, ("mid", "pane"), ranged="pane",
                          disjoint=True, buckets=8)

    @property
    def _margin(self) -> int:
        """Panes around an event whose windows share a minute with a window of the event."""
        return self.rule.panes + -(-60 // self.rule.slide_s)

    def start(self, messages: DataFrame, checkpoint: str | None = None, clock: bool = False, **run) -> StreamingQuery:
        """`clock` adds a rate source: time then passes without events. Decide on it at the
        first start, as the checkpoint counts the sources."""
        decoded = decode.decode_event(messages).observe(
            "events", F.count("*").alias("rows"),
            F.count_if(F.col("_error").isNotNull()).alias("rejected"))
        if clock:
            ticks = messages.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
            decoded = decoded.unionByName(ticks.select(F.unix_millis("timestamp").alias("_tick")), allowMissingColumns=True)
        return sinks.start(decoded, self.on_batch, checkpoint or f"{self.path}/_checkpoint", **run)

    def alerts(self, spark: SparkSession) -> DataFrame:
        """The alerts as they stand, per device and minute: a header row and its members."""
        stored = tables.read_table(spark, f"{self.path}/alerts", schemas.ALERT_TABLE, ["alert_date"])
        return tables.live_alerts(stored)

    # -- one batch ---------------------------------------------------------

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        """`batch`: decoded events, and ticks (`_tick`, time in milliseconds) if there is a clock."""
        spark, rule = batch.sparkSession, self.rule
        closed, newest = self._clock(spark, batch_id - 1)
        batch = self._too_late(batch, newest).persist()
        try:
            sinks.write_quarantine(batch, batch_id, f"{self.path}/_quarantine")
            events = decode.accepted(batch)
            tick = None
            if "_tick" in batch.columns:
                tick = events.agg(F.max(times.div(F.col("_tick"), rule.slide_s * 1000))).first()[0]
                events = events.filter("_tick IS NULL").drop("_tick")
            facts = alerts.pane_facts(events, rule).persist()
            oldest, last = facts.agg(F.min("pane"), F.max("pane")).first()
            if closed is None and oldest is not None:
                closed = oldest - 1
            if closed is not None:
                newest = max(p for p in (newest, last, tick) if p is not None)
                until = max(closed, newest - 1 - self.wait_s // rule.slide_s)
                late = self._late_minutes(facts, closed) if oldest is not None and oldest <= closed else None
                self._judge(spark, batch_id, facts, closed, until, late)
                closed = until
            self.ring.apply(facts, batch_id, self._oldest_of_use(closed, newest))
            self._set_clock(spark, batch_id, closed, newest)
            facts.unpersist()
        finally:
            batch.unpersist()

    def close(self, spark: SparkSession, last_batch: int) -> None:
        """Judge the windows still open, after the stream has ended for good."""
        closed, newest = self._clock(spark, last_batch)
        if newest is not None:
            none = spark.createDataFrame([], schemas.PANE_FACTS)
            self._judge(spark, last_batch + 1, none, closed, newest + self.rule.panes - 1, None)

    # -- steps -------------------------------------------------------------

    def _too_late(self, batch: DataFrame, newest: int | None) -> DataFrame:
        if self.keep_s is None or newest is None:
            return batch
        limit = newest * self.rule.slide_s - self.keep_s
        return batch.withColumn("_error", F.coalesce(
            "_error", F.when(F.col("ts") < limit * 1000, F.lit("too_late"))))

    def _oldest_of_use(self, closed: int | None, newest: int | None) -> int | None:
        """The first pane that a window still open, or an event not yet too late, can concern."""
        if self.keep_s is None or closed is None:
            return None
        return min(closed, newest - -(-self.keep_s // self.rule.slide_s)) - self._margin

    def _late_minutes(self, facts: DataFrame, closed: int) -> DataFrame:
        """`mid`, `minute`: where judged windows gain events."""
        first = times.minute_of(window_end_s(F.col("pane"), self.rule))
        last = times.minute_of(window_end_s(
            F.least(F.col("pane") + self.rule.panes - 1, F.lit(closed)), self.rule))
        return (facts.filter(F.col("pane") <= closed).select("mid", "pane").distinct()
                .select("mid", F.explode(F.sequence(first, last)).alias("minute"))
                .distinct().persist())

    def _panes(self, spark: SparkSession, first: int, last: int, more: list[int],
               before: int | None = None) -> DataFrame:
        """Stored facts of panes first .. last, and from more[0] to more[1], as of a batch."""
        wanted = F.col("pane").between(first, last)
        if more:
            wanted = wanted | F.col("pane").between(*more)
        low, high = min(first, *more[:1], first), max(last, *more[1:], last)
        return self.ring.read(spark, before, low=low, high=high).filter(wanted)

    def _judge(self, spark: SparkSession, batch_id: int, facts: DataFrame, closed: int, until: int,
               late: DataFrame | None) -> None:
        """Write the alerts of windows closed + 1 .. until, and of the late minutes."""
        rule = self.rule
        first, more = closed + 1 - (rule.panes - 1), []
        if late is not None:
            minutes = late.agg(F.min("minute"), F.max("minute")).first()
            more = [m * 60 // rule.slide_s + side for m, side in zip(minutes, (-self._margin, self._margin))]
        # What later batches added, should this one be repeated, is not seen.
        known = self._panes(spark, first, until, more, before=batch_id).unionByName(
            facts.select(*schemas.PANE_FACTS.names)).persist()

        def minutes(facts: DataFrame, low: int | None, high: int) -> DataFrame:
            spans = alert_spans(facts, rule).withColumn("last", F.least("last", F.lit(high)))
            if low is not None:
                spans = spans.withColumn("first", F.greatest("first", F.lit(low)))
            return last_window_per_minute(spans.filter(F.col("first") <= F.col("last")), rule)

        raised = minutes(known.filter(F.col("pane").between(first, until)), closed + 1, until)
        if late is not None:
            again = minutes(known.join(late.select("mid").distinct(), "mid", "left_semi"),
                            None, closed)
            raised = (raised.unionByName(again.join(late, ["mid", "minute"], "left_semi"))
                      .groupBy("mid", "minute").agg(F.max("w").alias("w")))
        raised = raised.persist()
        members = alerts.alert_members(known, raised.drop("minute"), rule).persist()
        try:
            rows = alerts.alert_rows(members).withColumn("withdrawn", F.lit(False))
            if late is not None:
                gone = late.join(raised, ["mid", "minute"], "left_anti").select(
                    times.alert_id(F.col("mid"), F.col("minute") * 60).alias("alert_id"), "mid",
                    (F.col("minute") * 60_000).alias("ts"), F.lit(alerts.HEADER).alias("kind"),
                    F.lit(True).alias("withdrawn"))
                rows = rows.unionByName(gone, allowMissingColumns=True)
            dated = rows.withColumn("alert_date", times.log_date(F.col("ts")))
            sinks.write_batch(dated, batch_id, f"{self.path}/alerts", "alert_date")
        finally:
            for frame in (members, raised, known, late):
                if frame is not None:
                    frame.unpersist()

    # -- clock -------------------------------------------------------------

    def _clock(self, spark: SparkSession, batch_id: int) -> tuple[int | None, int | None]:
        """Last judged window and newest pane as of a batch, (None, None) before the first."""
        if batch_id < 0:
            return None, None
        row = (spark.read.schema(_CLOCK).parquet(f"{self.path}/_clock/{batch_id}")
               .filter(F.col("batch_id") == batch_id).first())
        if row is None:
            raise RuntimeError(f"no clock of batch {batch_id} below {self.path}")
        return row.closed, row.newest

    def _set_clock(self, spark: SparkSession, batch_id: int, closed: int | None,
                   newest: int | None) -> None:
        row = dict(batch_id=batch_id, closed=closed, newest=newest)
        (spark.range(1, numPartitions=1)
         .select(*[F.lit(v).cast("long").alias(k) for k, v in row.items()])
         .write.mode("overwrite").parquet(f"{self.path}/_clock/{batch_id}"))
