import random

import pytest
from pyspark.sql import functions as F

from storepulse.operators import alerts
from storepulse.operators.sliding import AlertRule

RULE = AlertRule()
T0 = 1_705_320_000_000  # a full hour
SCHEMA = "mid string, evid string, uid string, itemid string, ts long"


def _events(spark, *rows):
    return spark.createDataFrame([(m, e, u, i, T0 + int(s * 1000)) for m, e, u, i, s in rows], SCHEMA)


def _coupons(mid, *uids, at=0.0, item="i"):
    return [(mid, "coupon", u, item, at + n) for n, u in enumerate(uids)]


def _by_window(events, rule):
    """Every event copied into every window that covers it."""
    coupon = F.col("evid") == rule.coupon
    return (events
            .groupBy("mid", F.window(F.timestamp_millis("ts"), f"{rule.window_s} seconds",
                                     f"{rule.slide_s} seconds").alias("w"))
            .agg(F.sort_array(F.collect_set(F.when(coupon, F.col("uid")))).alias("uids"),
                 F.sort_array(F.collect_set(F.when(coupon, F.col("itemid")))).alias("item_ids"),
                 F.sort_array(F.collect_list("evid")).alias("events"),
                 F.bool_or(F.col("evid") == rule.click).alias("clicked"))
            .filter((F.size("uids") >= rule.min_uids) & ~F.col("clicked"))
            .select("mid", F.unix_millis("w.end").alias("ts"), "uids", "item_ids", "events"))


def _rows(documents):
    return sorted((r.mid, r.ts, tuple(r.uids), tuple(r.item_ids), tuple(r.events))
                  for r in documents.collect())


def _whole(rows):
    """Alerts as documents, from their member rows; headers must agree with them."""
    names = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("name"))))
    copies = F.collect_list(F.when(F.col("kind") == "event", F.array_repeat("name", F.col("copies").cast("int"))))
    whole = rows.groupBy("alert_id", "mid", "ts").agg(
        names("uid").alias("uids"), names("item").alias("item_ids"), F.sort_array(F.flatten(copies)).alias("events"),
        F.max("n_uids").alias("n_uids"), F.max("n_items").alias("n_items"), F.max("n_events").alias("n_events"))
    assert whole.filter((F.size("uids") != F.col("n_uids")) | (F.size("item_ids") != F.col("n_items"))
                        | (F.size("events") != F.col("n_events"))).count() == 0
    return whole


def test_three_accounts_without_a_click(spark):
    got = _whole(alerts.coupon_alerts(_events(spark, *_coupons("a", "1", "2", "3"),
                                              ("a", "addCart", "9", "x", 1)), RULE))
    first = got.orderBy("ts").first()
    assert (first.uids, first.item_ids) == (["1", "2", "3"], ["i"])
    assert first.events == ["addCart", "coupon", "coupon", "coupon"]
    assert first.alert_id == f"a_{T0 // 60000}" and first.ts == T0 + 55_000
    assert got.count() == 6


def test_what_raises_no_alert(spark):
    events = _events(
        spark,
        *_coupons("two", "1", "2", "2"),
        *_coupons("null", "1", "2", None),
        *_coupons("click", "1", "2", "3"), ("click", "clickItem", "4", "i", 1),
        ("other", "addCart", "1", "i", 0), ("other", "addCart", "2", "i", 0), ("other", "addCart", "3", "i", 0),
        *_coupons("apart", "1", "2"), *_coupons("apart", "3", at=301))
    assert alerts.coupon_alerts(events, RULE).count() == 0


def test_click_outside_the_window_does_not_count(spark):
    events = _events(spark, ("a", "clickItem", "1", "i", -10), *_coupons("a", "1", "2", "3", at=0))
    assert _rows(_whole(alerts.coupon_alerts(events, RULE, True))) == _rows(_by_window(events, RULE))


def test_last_window_of_a_minute_is_kept(spark):
    events = _events(spark, *_coupons("a", "1", "2", "3", at=10), *_coupons("a", "4", at=40))
    every = _whole(alerts.coupon_alerts(events, RULE, every_window=True))
    last = every.groupBy("alert_id").agg(F.max("ts").alias("ts"))
    want = _rows(every.join(last, ["alert_id", "ts"], "left_semi"))
    assert _rows(_whole(alerts.coupon_alerts(events, RULE))) == want


@pytest.mark.parametrize("rule", [
    RULE, AlertRule(window_s=60, slide_s=20), AlertRule(window_s=1800, slide_s=300, min_uids=2),
    AlertRule(window_s=30, slide_s=30, min_uids=1), AlertRule(window_s=120, slide_s=7 * 5 - 5, bucket_s=1),
])
def test_equals_plain_windows_on_random_events(spark, rule, tmp_path):
    rng = random.Random(rule.window_s)
    rows = [(f"m{rng.randrange(3)}", rng.choice(["coupon"] * 8 + ["clickItem", "addCart", None]),
             rng.choice(["1", "2", "3", "4", None]), str(rng.randrange(5)), rng.uniform(-4000, 9000))
            for _ in range(700)]
    # One device holds a third of all rows, half of them copies of one event.
    rows += [("hot", "coupon", str(n % 40), str(n % 3), 3000 + (n % 700)) for n in range(250)]
    rows += [("hot", "coupon", "7", "1", 3333)] * 250
    events = _events(spark, *rows)
    want = _rows(_by_window(events, rule))
    assert want
    assert _rows(_whole(alerts.coupon_alerts(events, rule, True, staging=str(tmp_path / "s")))) == want


def test_a_large_alert_is_complete_in_bounded_rows(spark, tmp_path):
    events = _events(spark, *[("a", "coupon", str(n), str(n % 70), n / 100) for n in range(3000)],
                     *[("a", "addCart", "1", "1", 1)] * 500, *[("b", "addCart", "1", "1", 31)] * 20)
    rows = alerts.coupon_alerts(events, RULE, staging=str(tmp_path / "s"))
    header = rows.filter("kind = 'alert'").orderBy(F.desc("n_uids")).first()
    assert (header.n_uids, header.n_items, header.n_events) == (3000, 70, 3500)
    own = rows.filter((F.col("alert_id") == header.alert_id) & (F.col("kind") == "event"))
    assert {r.name: r.copies for r in own.collect()} == {"coupon": 3000, "addCart": 500}
    assert rows.filter("mid = 'b'").count() == 0


def test_staging_gives_the_same_alerts(spark, tmp_path):
    events = _events(spark, *_coupons("a", "1", "2", "3"), *_coupons("b", "1", "2"))
    assert _rows(_whole(alerts.coupon_alerts(events, RULE, staging=str(tmp_path / "w")))) == _rows(
        _whole(alerts.coupon_alerts(events, RULE)))


def test_window_must_be_a_multiple_of_the_slide():
    with pytest.raises(ValueError):
        AlertRule(window_s=300, slide_s=7)
