import pytest

from storepulse import schemas
from storepulse.operators import first_launch
from storepulse.sources import tables, topics
from storepulse.streaming import jobs, upkeep
from storepulse.streaming.counters import Counters

DAY = 86_400_000
NOON = 1705320000000  # 2024-01-15 12:00


def _start(mid, ts, **more):
    return {"mid": mid, "ts": ts, "type": "startup", "uid": "u", **more}


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "mid string, log_date string, ts long, id int")


def test_earliest_row_per_device_and_day(spark):
    got = first_launch.first_per_key(_rows(
        spark, ("a", "d1", 5, 1), ("a", "d1", 3, 2), ("a", "d2", 9, 3), ("b", "d1", 4, 5), ("b", "d1", 4, 4)),
        order=("ts", "id"))
    assert got.columns == ["mid", "log_date", "ts", "id"]
    assert sorted(map(tuple, got.collect())) == [
        ("a", "d1", 3, 2), ("a", "d2", 9, 3), ("b", "d1", 4, 4)]


@pytest.mark.parametrize("salts", [1, 3])
def test_unseen_keeps_devices_not_seen_that_day(spark, salts):
    rows = _rows(spark, ("a", "d1", 1, 1), ("a", "d2", 1, 2), ("a", "d2", 2, 3), ("b", "d1", 1, 4))
    seen = _rows(spark, ("a", "d1", 0, 0), ("a", "d1", 0, 9), ("c", "d1", 0, 0))
    got = first_launch.unseen(rows, seen, salts=salts)
    assert sorted(r.id for r in got.collect()) == [2, 3, 4]


def _run(spark, tmp_path, job, **kw):
    query = job(topics.read_folder(spark, str(tmp_path / "topics"), "startup"),
                str(tmp_path / "table"), once=True, **kw)
    query.awaitTermination()
    return query


def _stored(spark, tmp_path):
    rows = tables.read_table(spark, str(tmp_path / "table"), schemas.FIRST_LAUNCH_TABLE)
    return sorted((r.mid, r.log_date, r.ts) for r in rows.collect())


def test_stream_keeps_one_row_per_device_and_day_over_midnight(spark, tmp_path, put):
    put(tmp_path / "topics", "startup", _start("a", NOON), _start("a", NOON + DAY), _start("b", NOON + 1))
    _run(spark, tmp_path, jobs.first_launches)
    put(tmp_path / "topics", "startup", _start("a", NOON + 5), _start("c", NOON + 6), "{broken")
    _run(spark, tmp_path, jobs.first_launches)
    assert _stored(spark, tmp_path) == [
        ("a", "2024-01-15", NOON), ("a", "2024-01-16", NOON + DAY),
        ("b", "2024-01-15", NOON + 1), ("c", "2024-01-15", NOON + 6)]


def test_stream_forgets_days_behind_the_watermark(spark, tmp_path, put):
    put(tmp_path / "topics", "startup", _start("a", NOON))
    _run(spark, tmp_path, jobs.first_launches)
    put(tmp_path / "topics", "startup", _start("b", NOON + 5 * DAY))
    _run(spark, tmp_path, jobs.first_launches)
    put(tmp_path / "topics", "startup", _start("late", NOON))
    query = _run(spark, tmp_path, jobs.first_launches)
    assert [m for m, _, _ in _stored(spark, tmp_path)] == ["a", "b"]
    dropped = [op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]]
    assert sum(dropped) == 1


def test_exact_stream_takes_the_earliest_of_the_first_batch(spark, tmp_path, put):
    put(tmp_path / "topics", "startup", _start("a", NOON + 9), _start("a", NOON + 3), _start("b", NOON + DAY))
    _run(spark, tmp_path, jobs.first_launches_exact)
    put(tmp_path / "topics", "startup", _start("a", NOON), _start("b", NOON), _start("b", NOON + DAY + 1))
    query = _run(spark, tmp_path, jobs.first_launches_exact)
    assert _stored(spark, tmp_path) == [
        ("a", "2024-01-15", NOON + 3), ("b", "2024-01-15", NOON), ("b", "2024-01-16", NOON + DAY)]
    assert query.lastProgress["observedMetrics"]["startups"].rows == 3


def test_exact_stream_repeats_a_batch_after_a_crash(spark, tmp_path, put, monkeypatch):
    """The batch is written, its commit is lost, and it runs again."""
    put(tmp_path / "topics", "startup", _start("a", NOON))
    _run(spark, tmp_path, jobs.first_launches_exact)
    put(tmp_path / "topics", "startup", _start("a", NOON + 1), _start("b", NOON + 2))
    _run(spark, tmp_path, jobs.first_launches_exact)
    before = _stored(spark, tmp_path)
    for lost in (tmp_path / "table" / "_checkpoint" / "commits").glob("*1*"):
        lost.unlink()
    _run(spark, tmp_path, jobs.first_launches_exact)
    assert _stored(spark, tmp_path) == before == [("a", "2024-01-15", NOON), ("b", "2024-01-15", NOON + 2)]


def test_no_late_launch_is_lost(spark, tmp_path, put):
    """Launches two days late, before and after a restart, and once more after a lost commit."""
    held = lambda: sorted((r.mid, r.log_date) for r in upkeep.launches(spark, str(tmp_path / "table")).collect())
    put(tmp_path / "topics", "startup", _start("a", NOON + 2 * DAY), _start("early", NOON))
    _run(spark, tmp_path, jobs.first_launches)
    put(tmp_path / "topics", "startup", _start("b", NOON), _start("b", NOON + 9), _start("a", NOON), _start("a", NOON + 2 * DAY))
    query = _run(spark, tmp_path, jobs.first_launches)
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) >= 2
    put(tmp_path / "topics", "startup", _start("b", NOON + 5), _start("c", NOON), "{broken")
    _run(spark, tmp_path, jobs.first_launches)
    want = [("a", "2024-01-15"), ("a", "2024-01-17"), ("b", "2024-01-15"), ("c", "2024-01-15"), ("early", "2024-01-15")]
    assert held() == want
    for lost in (tmp_path / "table" / "_checkpoint_quarantine" / "commits").glob("*[12]*"):
        lost.unlink()
    _run(spark, tmp_path, jobs.first_launches)
    assert held() == want
    assert [r.mid for r in upkeep.launches(spark, str(tmp_path / "table"), "2024-01-17", "2024-01-17").collect()] == ["a"]


def test_counts_of_every_batch_are_stored(spark, tmp_path, put):
    counters = Counters(str(tmp_path / "counters"))
    for lines in ((_start("a", NOON), _start("a", NOON + 1), "{broken"), (_start("a", NOON + 2), _start("b", NOON))):
        put(tmp_path / "topics", "startup", *lines)
        counters.wait(_run(spark, tmp_path, jobs.first_launches_exact, counters=counters))
    found = sorted((r.batch, r.counter, r.n) for r in counters.read(spark).collect())
    assert found == [(0, "kept", 1), (0, "rejected", 1), (0, "rows", 3), (1, "kept", 1), (1, "rejected", 0), (1, "rows", 2)]
