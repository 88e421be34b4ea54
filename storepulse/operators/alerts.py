"""Coupon alerts: which windows, their contents, and the documents written for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.functions import times
from storepulse.operators.sliding import (
    AlertRule, alert_spans, last_window_per_minute, span_windows, window_end_s, with_pane)


def pane_facts(events: DataFrame, rule: AlertRule) -> DataFrame:
    """Events counted per device, pane, name, account and item."""
    return (with_pane(events, rule)
            .groupBy("mid", "pane", "evid", "uid", "itemid")
            .agg(F.count("*").alias("n")))


def _slots(w, rule: AlertRule):
    """The one or two window-long slots of time that window `w` touches."""
    n = rule.panes
    return F.array_distinct(F.array(times.div(w - (n - 1), n), times.div(w, n)))


#: What an alert's member rows list: accounts and items of its coupons, names of all its events.
KINDS = ("uid", "item", "event")
HEADER = "alert"


def alert_members(facts: DataFrame, windows: DataFrame, rule: AlertRule, salts: int = 8) -> DataFrame:
    """The contents of the given windows: `alert_id`, `mid`, `ts` (window end), `kind`, `name`, `copies`.

    `facts` has mid, pane, evid, uid, itemid and n, and holds at least the slots
    of time that `windows` (mid, w) touch. Every distinct account, item and event
    name is one row with the number of events that have it, so no row grows with
    the window, and each step is combined before its shuffle.

    Windows and facts meet on device and slot, with the facts of every slot spread
    over `salts` tasks and the (few) windows copied to each.
    """
    placed = facts.withColumn("slot", times.div(F.col("pane"), rule.panes))
    spread = (windows.select("mid", "w")
              .withColumn("slot", F.explode(_slots(F.col("w"), rule)))
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    inside = (placed
              .withColumn("salt", F.pmod(F.xxhash64("uid", "itemid", "evid", "pane"),
                                         F.lit(salts)).cast("int"))
              .join(spread, ["mid", "slot", "salt"])
              .filter(F.col("pane").between(F.col("w") - (rule.panes - 1), F.col("w"))))
    coupon = F.col("evid") == rule.coupon
    names = (F.when(coupon, F.col("uid").cast("string")), F.when(coupon, F.col("itemid").cast("string")),
             F.col("evid"))
    entries = F.array(*[F.struct(F.lit(k).alias("kind"), name.alias("name")) for k, name in zip(KINDS, names)])
    end = window_end_s(F.col("w"), rule)
    return (inside.select("mid", "w", "n", F.inline(entries))
            .filter(F.col("name").isNotNull())
            .groupBy("mid", "w", "kind", "name").agg(F.sum("n").alias("copies"))
            .select(times.alert_id(F.col("mid"), end).alias("alert_id"), "mid",
                    (end * 1000).alias("ts"), "kind", "name", "copies"))


def alert_headers(members: DataFrame) -> DataFrame:
    """One row per alert: `alert_id`, `mid`, `ts`, `n_uids`, `n_items`, `n_events`."""
    of = lambda kind: F.col("kind") == kind
    return members.groupBy("alert_id", "mid", "ts").agg(
        F.count_if(of("uid")).alias("n_uids"), F.count_if(of("item")).alias("n_items"),
        F.sum(F.when(of("event"), F.col("copies")).otherwise(0)).alias("n_events"))


def alert_rows(members: DataFrame) -> DataFrame:
    """Headers (kind `alert`) and members in one frame of one shape, whatever an alert's size."""
    return alert_headers(members).withColumn("kind", F.lit(HEADER)).unionByName(
        members, allowMissingColumns=True)


def _near(facts: DataFrame, windows: DataFrame, rule: AlertRule) -> DataFrame:
    """Facts of devices and slots that some window touches."""
    slots = windows.select("mid", F.explode(_slots(F.col("w"), rule)).alias("_slot"))
    return (facts.withColumn("_slot", times.div(F.col("pane"), rule.panes))
            .join(slots, ["mid", "_slot"], "left_semi").drop("_slot"))


def coupon_alerts(events: DataFrame, rule: AlertRule = AlertRule(), every_window: bool = False,
                  staging: str | None = None) -> DataFrame:
    """Alerts of a bounded set of events, per minute or per window, as `alert_rows`.

    With `staging`, a folder all executors share, the events counted per pane, the
    qualifying windows and the members are written there, each once. The windows' true
    size is then known when the facts are joined to them: few windows are broadcast and
    the facts are not shuffled; and the headers are counted from what is written. Without it the whole result
    is one lazy plan, which works the windows out several times: for trials only.
    """
    def settle(rows: DataFrame, name: str) -> DataFrame:
        if not staging:
            return rows
        rows.write.parquet(f"{staging}/{name}")
        return rows.sparkSession.read.schema(rows.schema).parquet(f"{staging}/{name}")

    facts = settle(pane_facts(events, rule), "facts")
    spans = alert_spans(facts, rule)
    windows = settle(span_windows(spans) if every_window
                     else last_window_per_minute(spans, rule).drop("minute"), "windows")
    return alert_rows(settle(alert_members(_near(facts, windows, rule), windows, rule), "members"))
