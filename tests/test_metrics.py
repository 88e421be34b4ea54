import io
import json
from contextlib import redirect_stdout

import pytest

from storepulse import schemas
from storepulse.plans import metrics
from storepulse.sources import tables
from storepulse.streaming import sinks

DAY, BEFORE = "2024-03-01", "2024-02-29"


@pytest.fixture
def dau(spark):
    return spark.createDataFrame([
        ("a", BEFORE, "23"), ("a", DAY, "00"), ("b", DAY, "00"), ("c", DAY, "13"),
        ("c", "2024-01-01", "05"), ("d", "2024-03-02", "01")], "mid string, log_date string, log_hour string")


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([
        (BEFORE, "09", 0.1), (BEFORE, "09", 0.2), (DAY, "10", 5.25), (DAY, "24", 1.0),
        (DAY, "11", None)], "create_date string, create_hour string, total_amount double")


@pytest.fixture
def both(dau, orders):
    return {"dau": dau, "orders": orders}


def test_daily_totals(dau, orders):
    assert metrics.dau_total(dau, DAY).first().ct == 3
    assert metrics.order_amount(orders, DAY).first().order_amount == 6.25
    assert metrics.order_amount(orders, BEFORE).first().order_amount == 0.3
    assert metrics.new_devices(dau, DAY).first().ct == 1


def test_empty_day_counts_zero_devices_and_no_amount(dau, orders):
    assert metrics.dau_total(dau, "2030-01-01").first().ct == 0
    assert metrics.order_amount(orders, "2030-01-01").first().order_amount is None
    assert metrics.dau_by_hour(dau, "2030-01-01").count() == 0


def test_by_hour(dau, orders):
    assert {r.log_hour: r.ct for r in metrics.dau_by_hour(dau, DAY).collect()} == {"00": 2, "13": 1}
    assert {r.create_hour: r.order_amount for r in metrics.order_amount_by_hour(orders, DAY).collect()} == {
        "10": 5.25, "24": 1.0, "11": None}


def test_totals_in_order(dau, orders):
    rows = metrics.realtime_total(dau, orders, DAY).orderBy("ord").collect()
    assert [(r.id, r.value) for r in rows] == [("dau", 3.0), ("new_mid", 1.0), ("order_amount", 6.25)]


def test_totals_as_json(dau, orders):
    got = json.loads(metrics.realtime_total_json(dau, orders, DAY).first().json)
    assert [(x["id"], x["name"], x["value"]) for x in got] == [
        ("dau", "新增日活", 3), ("new_mid", "新增日活", 1), ("order_amount", "新增交易额", 6.25)]
    assert "value" not in json.loads(metrics.realtime_total_json(dau, orders, "2030-01-01").first().json)[2]


def test_hours_of_two_days_on_the_full_axis(both):
    rows = {r.hour: (r.yesterday, r.today) for r in metrics.realtime_hour(both, "dau", DAY).collect()}
    assert len(rows) == 24
    assert {h: v for h, v in rows.items() if v != (0, 0)} == {"00": (0, 2), "13": (0, 1), "23": (1, 0)}
    amounts = {r.hour: (r.yesterday, r.today) for r in metrics.realtime_hour(both, "order_amount", DAY).collect()}
    assert {h: v for h, v in amounts.items() if v != (0, 0)} == {"09": (0.3, 0), "10": (0, 5.25)}


def test_hour_maps_hold_only_hours_with_rows(both):
    got = json.loads(metrics.realtime_hour_json(both, "dau", DAY).first().json)
    assert got == {"yesterday": {"23": 1}, "today": {"00": 2, "13": 1}}
    assert json.loads(metrics.realtime_hour_json(both, "dau", "2030-01-01").first().json) == {
        "yesterday": {}, "today": {}}


def test_unknown_metric_gives_nothing(both):
    assert metrics.hourly_series(both, "nope", DAY).count() == 0
    assert metrics.realtime_hour(both, "nope", DAY).count() == 0
    assert metrics.realtime_hour_json(both, "nope", DAY).count() == 0


def test_day_filters_prune_the_serving_table(spark, tmp_path, dau):
    path = str(tmp_path / "dau")
    rows = dau.selectExpr("mid", "log_date", "log_hour", *[
        f"cast(null as {t}) {c}" for c, t in
        [(c, "bigint" if c == "ts" else "string") for c in schemas.FIRST_LAUNCH_COLUMNS
         if c not in dau.columns]]).select(*schemas.FIRST_LAUNCH_COLUMNS)
    sinks.write_batch(rows, 0, path, "log_date")
    stored = tables.read_table(spark, path, schemas.FIRST_LAUNCH_TABLE)
    both = {"dau": stored, "orders": stored}
    for frame, days in [(metrics.dau_total(stored, DAY), [DAY]),
                        (metrics.realtime_hour(both, "dau", DAY), [DAY, BEFORE])]:
        out = io.StringIO()
        with redirect_stdout(out):
            frame.explain("formatted")
        filters = [x for x in out.getvalue().splitlines() if "PartitionFilters" in x]
        assert len(filters) == 1 and all(day in filters[0] for day in days)
        assert "mid" not in [x for x in out.getvalue().splitlines() if "ReadSchema" in x][0]
    assert metrics.dau_total(stored, DAY).first().ct == 3
