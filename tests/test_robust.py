"""Rows that cannot be used, and plans that must hold at any size."""

import pytest

import __spark_entry__ as registry
from conftest import SF_DIR
from storepulse import schemas
from storepulse.operators import decode, first_launch
from storepulse.plans import metrics, sale_detail
from storepulse.sources import changes, tables, topics
from storepulse.streaming import jobs, sinks
from storepulse.streaming.alert_job import CouponAlertJob

T0 = 1_705_320_000_000


def _log(mid, ts, **more):
    return {"mid": mid, "ts": ts, "type": "startup", **more}


def _reasons(spark, path):
    return sorted(r._error for r in tables.read_table(spark, path, schemas.QUARANTINE_TABLE).collect())


@pytest.mark.parametrize("ts", [2**63 - 1, -1, 253_402_300_800_000])
def test_a_time_out_of_range_is_rejected(lines, ts):
    row = decode.decode_startup(lines(_log("a", ts))).first()
    assert (row._error, row.log_date, row.log_hour) == ("bad_ts", None, None)


@pytest.mark.parametrize("amount,error", [("NaN", "bad_total_amount"), ("Infinity", "bad_total_amount"),
                                          ("1e300", "bad_total_amount"), ("-1e16", "bad_total_amount"), ("12.5", None)])
def test_amounts_that_do_not_fit_are_rejected(lines, amount, error):
    order = {"id": "1", "consignee_tel": "138", "create_time": "2024-01-15 10:00:00", "total_amount": amount}
    rows = decode.decode_order(lines(order))
    assert rows.first()._error == error
    assert metrics.order_amount(decode.accepted(rows), "2024-01-15").count() == 1


def test_launch_jobs_go_on_and_keep_what_they_reject(spark, tmp_path, put):
    put(tmp_path / "topics", "startup", _log("a", T0), _log("b", 2**63 - 1), "{broken", _log(None, T0), _log("a", T0 + 5))
    source = lambda: topics.read_folder(spark, str(tmp_path / "topics"), "startup")
    for job, path in ((jobs.first_launches, str(tmp_path / "s")), (jobs.first_launches_exact, str(tmp_path / "e"))):
        job(source(), path, once=True).awaitTermination()
        stored = tables.read_table(spark, path, schemas.FIRST_LAUNCH_TABLE).collect()
        assert [(r.mid, r.ts) for r in stored] == [("a", T0)]
        assert _reasons(spark, f"{path}/_quarantine") == ["bad_json", "bad_ts", "missing_mid"]


def test_one_state_row_per_device_and_day(spark, tmp_path, put):
    put(tmp_path / "topics", "startup", *[_log("hot", T0 + i, uid=str(i)) for i in range(100)], _log("b", T0))
    query = jobs.first_launches(topics.read_folder(spark, str(tmp_path / "topics"), "startup"), str(tmp_path / "t"),
                                state_partitions=3, once=True)
    query.awaitTermination()
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    assert max(o["numRowsTotal"] for o in operators) == 2 and operators[0]["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_alert_job_survives_a_far_future_event(spark, tmp_path, put):
    job = CouponAlertJob(str(tmp_path / "job"))
    put(tmp_path / "topics", "event", _log("a", 2**63 - 1), _log("a", T0))
    job.start(topics.read_folder(spark, str(tmp_path / "topics"), "event"), once=True).awaitTermination()
    assert job._clock(spark, 0)[1] == T0 // 5000
    assert _reasons(spark, str(tmp_path / "job" / "_quarantine")) == ["bad_ts"]


def test_alert_job_reads_existing_folders_only(spark, tmp_path, put):
    """An accepted time far ahead: the folders up to it are not named one by one."""
    job, path = CouponAlertJob(str(tmp_path / "job")), str(tmp_path / "topics")
    for ts in (T0, 253_402_200_000_000, T0 + 5_000):
        put(tmp_path / "topics", "event", _log("a", ts))
        job.start(topics.read_folder(spark, path, "event"), once=True).awaitTermination()
    assert job._clock(spark, 2)[1] == 253_402_200_000 // 5
    assert job._panes(spark, T0 // 5000, 253_402_200_000 // 5, []).count() == 3


def _order(number, **more):
    return {"id": number, "consignee_tel": "138", "create_time": "2024-01-15 10:00:00", "operate_time": "2024-01-15 11:00:00", **more}


def test_orders_without_id_are_kept_apart(spark, tmp_path, put):
    put(tmp_path / "topics", "order", _order(None, total_amount="1"), _order("", total_amount="2"), _order("7", total_amount="3"))
    jobs.ingest_orders(topics.read_folder(spark, str(tmp_path / "topics"), "order"), str(tmp_path / "t"), once=True).awaitTermination()
    assert [(r.id, r.total_amount) for r in tables.read_orders(spark, str(tmp_path / "t")).collect()] == [("7", 3.0)]
    assert _reasons(spark, str(tmp_path / "t" / "_quarantine")) == ["missing_id", "missing_id"]


def test_of_equal_versions_the_last_to_arrive_holds(spark, tmp_path, put):
    put(tmp_path / "topics", "order", _order("1", total_amount="9"), _order("2", total_amount="1", operate_time=None),
        _order("1", total_amount="5", consignee="first"), _order("2", total_amount="0.5", operate_time=None),
        _order("1", total_amount="5", consignee="a last"))
    jobs.ingest_orders(topics.read_folder(spark, str(tmp_path / "topics"), "order"), str(tmp_path / "t"), once=True).awaitTermination()
    rows = tables.read_orders(spark, str(tmp_path / "t")).collect()
    assert sorted((r.id, r.total_amount, r.consignee) for r in rows) == [("1", 5.0, "a last"), ("2", 0.5, None)]


def test_change_feed_keeps_unreadable_entries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = '{"entry_type":"ROWDATA","table":"order_info","type":"INSERT","rows":[{"after":[{"name":"id","value":"1"}]}]}'
    (tmp_path / "in" / "a.json").write_text("\n".join([good, "{broken", '{"type":"INSERT"}']))
    jobs.forward_changes(changes.stream_entries(spark, str(tmp_path / "in")), sinks.topic_folder(str(tmp_path / "out")),
                         str(tmp_path / "ck"), once=True).awaitTermination()
    assert [r.value for r in topics.read_folder_once(spark, str(tmp_path / "out")).collect()] == ['{"id":"1"}']
    assert _reasons(spark, str(tmp_path / "ck_quarantine")) == ["bad_json", "missing_table"]


def test_first_launches_are_found_without_a_sort(spark):
    plan = registry.queries()["first_launch_batch"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan


def test_earliest_packs_any_pair_of_numbers(spark):
    rows = [("a", "d", 5, 2**63 - 1), ("a", "d", 5, -2**63), ("b", "d", 253_402_300_799_999, 0), ("b", "d", 253_402_300_799_999, 7),
            ("c", "d", 0, -1), ("c", "d", 1, -9)]
    frame = spark.createDataFrame(rows, "mid string, log_date string, ts long, event_id long")
    assert sorted(map(tuple, first_launch.earliest_per_key(frame).collect())) == [
        ("a", "d", 5, -2**63), ("b", "d", 253_402_300_799_999, 0), ("c", "d", 0, -1)]


def test_stored_metrics_read_one_folder(spark):
    for name, column in (("stored_dau_hour", "log_date"), ("stored_order_amount_hour", "create_month")):
        plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({column}" in plan


def test_metrics_default_to_today(spark):
    today = spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd') AS d").first().d
    dau = spark.createDataFrame([("a", today, "01"), ("b", "2000-01-01", "02")], "mid string, log_date string, log_hour string")
    assert metrics.dau_total(dau).first().ct == 1
    assert metrics.new_devices_stored(metrics.first_days(dau)).first().ct == 1


def test_the_document_has_both_facets_without_hits(spark):
    found = registry._found(spark, SF_DIR, "no such item")
    assert sale_detail.result_json(found, 0, 10).first().json == (
        '{"total":0,"stat":[{"facet":"age","options":[]},{"facet":"gender","options":[]}],"detail":[]}')
    plan = sale_detail.result_json(found, 0, 10)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
