from storepulse import schemas
from storepulse.operators import decode

PHONE = "13812345678"
TIME = "2020-05-06 07:08:09"


def test_startup_fields_and_derived_columns(lines):
    row = decode.accepted(decode.decode_startup(lines(
        {"mid": "m1", "uid": 7, "ts": 1705276800000, "type": "startup", "unknown": {"a": 1}}))).first()
    assert (row.mid, row.uid, row.ts, row.ch) == ("m1", "7", 1705276800000, None)
    assert (row.log_date, row.log_hour) == ("2024-01-15", "00")


def test_quoted_numbers_and_numbers_for_strings(lines):
    row = decode.accepted(decode.decode_event(lines(
        {"mid": 5, "ts": "1705276800000", "itemid": 31, "evid": "coupon"}))).first()
    assert (row.mid, row.ts, row.itemid) == ("5", 1705276800000, "31")


def test_unusable_logs_are_set_aside_and_the_rest_goes_on(lines):
    decoded = decode.decode_startup(lines(
        {"mid": "ok", "ts": 1}, "{broken", "", None, "[1, 2]", {"ts": 1}, {"mid": "m"},
        {"mid": "m", "ts": "soon"}))
    assert [r.mid for r in decode.accepted(decoded).collect()] == ["ok"]
    errors = sorted((r._error, r._raw) for r in decode.quarantined(decoded).fillna("").collect())
    assert [e for e, _ in errors] == [
        "bad_json", "bad_json", "bad_ts", "empty", "empty", "missing_mid", "missing_ts"]


def test_order_with_quoted_amount(lines):
    row = decode.accepted(decode.decode_order(lines(
        {"id": "1", "total_amount": "12.50", "consignee_tel": PHONE, "create_time": TIME}))).first()
    assert (row.total_amount, row.consignee_tel) == (12.5, "138********")
    assert (row.create_date, row.create_hour) == ("2020-05-06", "07")
    assert set(schemas.ORDER_COLUMNS) == set(row.asDict())


def test_order_without_amount_is_kept(lines):
    order = {"id": "1", "consignee_tel": PHONE, "create_time": TIME}
    rows = decode.accepted(decode.decode_order(lines(order, {**order, "total_amount": ""}))).collect()
    assert [r.total_amount for r in rows] == [None, None]


def test_unusable_orders(lines):
    good = {"id": "1", "total_amount": "1", "consignee_tel": PHONE, "create_time": TIME}
    decoded = decode.decode_order(lines(
        good, {**good, "consignee_tel": None}, {**good, "create_time": "2020-05-06"},
        {**good, "create_time": "2020-05-06 "}, {**good, "create_time": None},
        {**good, "total_amount": "n/a"}))
    assert decode.accepted(decoded).count() == 1
    assert sorted(r._error for r in decode.quarantined(decoded).collect()) == [
        "bad_create_time", "bad_create_time", "bad_create_time", "bad_total_amount",
        "missing_consignee_tel"]


def test_extra_fields_are_kept_as_text(lines):
    row = decode.decode_event(lines({"mid": "m", "ts": 1, "event_id": 9}), extra=["event_id"]).first()
    assert row.event_id == "9"
