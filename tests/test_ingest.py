import json

from pyspark.sql import functions as F

from storepulse.operators import changefeed, decode, routing


def _routed(rows):
    return decode.accepted(routing.stamp_and_route(rows, now=F.lit(99))).collect()


def test_only_startup_goes_to_the_startup_topic(lines):
    rows = _routed(lines({"type": "startup", "i": 0}, {"type": "event", "i": 1}, {"i": 2},
                         {"type": None, "i": 3}, {"type": "Startup", "i": 4}))
    assert {json.loads(r.value)["i"]: r.topic for r in rows} == {
        0: "startup", 1: "event", 2: "event", 3: "event", 4: "event"}


def test_client_time_is_replaced_and_open_fields_survive(lines):
    sent = {"type": "event", "ts": 1, "n": 1.5, "deep": {"list": [1, "a", None], "t": True}, "nil": None}
    row, = _routed(lines(sent))
    assert json.loads(row.value) == {**sent, "ts": 99}
    assert (row.ts, row.log_date) == (99, "1970-01-01")


def test_repeated_key_keeps_the_last_value(lines):
    row, = _routed(lines('{"a": 1, "a": 2, "ts": 3}'))
    assert json.loads(row.value) == {"a": 2, "ts": 99}


def test_broken_line_is_set_aside(lines):
    routed = routing.stamp_and_route(lines("{oops", {"type": "startup"}))
    assert [r._raw for r in decode.quarantined(routed).collect()] == ["{oops"]
    stamped = decode.accepted(routed).first()
    assert json.loads(stamped.value)["ts"] == stamped.ts > 1_600_000_000_000


def _entry(table="order_info", type="INSERT", entry_type="ROWDATA", rows=(({"id": "1"},),)):
    cells = [[{"name": k, "value": v} for part in row for k, v in part.items()] for row in rows]
    return {"entry_type": entry_type, "table": table, "type": type,
            "rows": [{"after": c} for c in cells]}


def _flat(lines, *entries, **kw):
    from storepulse.sources.changes import parse_entries
    return [(r.topic, json.loads(r.value)) for r in
            changefeed.flatten_changes(parse_entries(lines(*entries)), **kw).collect()]


def test_only_inserted_rows_of_the_routed_table_pass(lines):
    assert _flat(lines, _entry(), _entry(type="UPDATE"), _entry(type="DELETE"),
                 _entry(table="user_info"), _entry(entry_type="TRANSACTIONBEGIN"),
                 _entry(rows=())) == [("order", {"id": "1"})]


def test_one_message_per_row_and_the_last_of_equal_names(lines):
    rows = [({"id": "1"}, {"v": "a"}, {"id": "2"}), ({"id": "3"}, {"v": None})]
    assert _flat(lines, _entry(rows=rows)) == [("order", {"v": "a", "id": "2"}), ("order", {"id": "3"})]


def test_routes_and_types_are_parameters(lines):
    assert _flat(lines, _entry(table="t", type="UPDATE"), _entry(),
                 routes={"t": "other"}, types=("UPDATE",)) == [("other", {"id": "1"})]
