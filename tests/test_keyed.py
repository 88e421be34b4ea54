import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storepulse import schemas
from storepulse.sources import files, tables, topics
from storepulse.sources.keyed import KeyedTable
from storepulse.streaming import jobs, upkeep

NOON, DAY = 1_705_320_000_000, 86_400_000
ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.StringType()),
                    T.StructField("v", T.LongType())])


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _held(table, spark, **kw):
    rows = [tuple(r) for r in table.read(spark, **kw).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return sorted(rows)


def _batches(n, keys=60, each=20, seed=1):
    rng = random.Random(seed)
    return [[(str(k), f"2024-01-{1 + b // 4:02d}", b) for k in rng.sample(range(keys), each)] for b in range(n)]


def _newest(batches):
    return sorted({row[0]: row for batch in batches for row in batch}.values())


@pytest.mark.parametrize("small_rows", [0, 1000])
def test_reads_as_a_dictionary_would(spark, tmp_path, small_rows):
    table = KeyedTable(str(tmp_path), ROW, ("id",), ranged="day", filtered=True, buckets=3, small_rows=small_rows)
    assert _held(table, spark) == []
    batches = _batches(6)
    for b, rows in enumerate(batches):
        table.apply(spark.createDataFrame(rows, ROW), b)
        assert _held(table, spark) == _newest(batches[:b + 1])
    assert _held(table, spark, before=4) == _newest(batches[:4])
    table.apply(spark.createDataFrame([], ROW), 6)
    want = _newest(batches)
    assert _held(table, spark) == want
    # A row that was replaced on another day does not come back when its old day is asked for.
    assert _held(table, spark, low="2024-01-01", high="2024-01-01") == [r for r in want if r[1] == "2024-01-01"]
    assert _held(table, spark, keys=["3", "17", "none"]) == [r for r in want if r[0] in ("3", "17")]
    asked = spark.createDataFrame([(str(k), "2024-01-02") for k in range(50, 70)], "id string, day string")
    for literals in (3, 1000):
        assert sorted(map(tuple, table.lookup(asked, literals=literals).collect())) == [r for r in want if int(r[0]) >= 50]


def test_files_depend_on_rows_and_not_on_batches(spark, tmp_path):
    rows = [(str(k), "2024-01-01", k) for k in range(120)]
    opened = []
    for n in (3, 30):
        table = KeyedTable(str(tmp_path / str(n)), ROW, ("id",), buckets=2, small_rows=1000)
        for b in range(n):
            table.apply(spark.createDataFrame(rows[b * 120 // n:(b + 1) * 120 // n], ROW), b)
        assert _held(table, spark) == sorted(rows)
        opened.append(len(table.read(spark).inputFiles()))
        assert len(files.names(spark, f"{tmp_path}/{n}/runs")) <= table.keep
        assert len(files.names(spark, f"{tmp_path}/{n}/manifest")) == table.keep
    assert opened == [2, 2]


def test_runs_grow_geometrically(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ROW, ("id",), buckets=2, small_rows=0)
    for b in range(9):
        table.apply(spark.createDataFrame([(f"{b}-{i}", "d", b) for i in range(4)], ROW), b)
        sizes = [r.rows for r in table.live_runs(spark)]
        assert sum(sizes) == 4 * (b + 1) and all(x >= 2 * y for x, y in zip(sizes, sizes[1:]))


def test_a_crash_before_the_manifest_loses_nothing(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ROW, ("id",), filtered=True, buckets=2, small_rows=1000)
    batches = _batches(4)
    for b, rows in enumerate(batches[:3]):
        table.apply(spark.createDataFrame(rows, ROW), b)
    frame = spark.createDataFrame(batches[3], ROW)
    table._merged(spark, table.live_runs(spark), frame, len(batches[3]), 3)  # merged, then the driver is lost
    assert _held(table, spark) == _newest(batches[:3])
    (tmp_path / "manifest" / "000000000003.json.part").write_text('[{"run"')  # a manifest without its end
    assert _held(table, spark) == _newest(batches[:3])
    for _ in range(2):  # the batch comes again, and once more after its manifest was written
        table.apply(frame, 3)
        assert _held(table, spark) == _newest(batches)
    for b in (4, 5):
        table.apply(spark.createDataFrame([("n", "d", 9)], ROW), b)
    assert len(files.names(spark, f"{tmp_path}/runs")) <= table.keep + 1


def test_reading_and_counting_do_not_shuffle(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ROW, ("id",), buckets=4, small_rows=0)
    for b, n in enumerate((40, 10)):
        table.apply(spark.createDataFrame([(str(i), "d", b) for i in range(n)], ROW), b)
    assert len(table.live_runs(spark)) == 2
    plan = _plan(table.read(spark).groupBy("id").count())
    assert "Exchange" not in plan and "Sort" not in plan and plan.count("Bucketed: true") >= 2


def test_filters_and_buckets_keep_files_closed(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ROW, ("id",), filtered=True, buckets=8)
    table.apply(spark.createDataFrame([(str(i), "d", i) for i in range(500)], ROW), 0)
    keys = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert "parquet" not in _plan(table.lookup(keys("none of them")))
    one = table.lookup(keys("77", "gone"))
    assert "SelectedBucketsCount: 1 out of 8" in _plan(one) and [r.v for r in one.collect()] == [77]
    held = table._may_hold(spark, table.live_runs(spark)[0], keys(*[f"x{i}" for i in range(2000)])).count()
    assert held < 200  # strangers that pass
    assert table._may_hold(spark, table.live_runs(spark)[0], keys(*map(str, range(500)))).count() == 500


def test_runs_of_other_days_are_not_opened(spark, tmp_path):
    seen = upkeep.seen_launches(str(tmp_path), buckets=2, small_rows=0)
    for b, (day, n) in enumerate((("2024-01-01", 40), ("2024-01-02", 10))):
        seen.apply(spark.createDataFrame([(str(i), day) for i in range(n)], "mid string, log_date string"), b)
    assert len(seen.live_runs(spark)) == 2
    day = seen.read(spark, low="2024-01-02", high="2024-01-02")
    assert day.count() == 10 and len(day.inputFiles()) == 2 and len(seen.read(spark).inputFiles()) == 4


@pytest.mark.parametrize("small_rows", [0, 1000])
def test_a_staged_batch_reads_as_one_that_is_applied(spark, tmp_path, small_rows):
    table = KeyedTable(str(tmp_path), ROW, ("id",), filtered=True, buckets=3, small_rows=small_rows)
    batches = [*_batches(5), []]
    for b, rows in enumerate(batches):
        run = table.stage(spark.createDataFrame(rows, ROW), b)
        assert _held(table, spark) == _newest(batches[:b])  # nothing is replaced yet
        assert sorted(map(tuple, table.staged(spark, run).collect())) == sorted(rows)
        for again in range(2):  # also when the batch is repeated
            table.settle(spark, table.stage(spark.createDataFrame(rows, ROW), b) if again else run, b)
            assert _held(table, spark) == _newest(batches[:b + 1])
        live = {r.run for r in table.live_runs(spark)}
        assert live <= set(files.names(spark, f"{tmp_path}/runs")) and live <= set(files.names(spark, f"{tmp_path}/filters"))
    asked = spark.createDataFrame([(str(k),) for k in range(50, 70)], "id string")
    found = [r for r in _newest(batches) if int(r[0]) >= 50]
    assert sorted(map(tuple, table.lookup(asked, literals=3, n=20).collect())) == found
    assert sorted(map(tuple, table.lookup(asked, n=20).collect())) == found


def test_many_keys_are_joined_without_asking_filters(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ROW, ("id",), filtered=True, buckets=4, small_rows=0)
    for b, n in enumerate((400, 100)):
        table.apply(spark.createDataFrame([(str(i), "d", b) for i in range(n)], ROW), b)
    run = table.stage(spark.createDataFrame([(str(i), "d", 2) for i in range(50, 450)], ROW), 2)
    found = table.lookup(table.staged(spark, run).select("id"), 2, literals=10, n=run.rows)
    plan = _plan(found)
    assert "Exchange" not in plan and "Sort" not in plan and "bits" not in plan
    assert sorted(map(tuple, found.collect())) == sorted((str(i), "d", int(i < 100)) for i in range(50, 400))


# -- what jobs keep ---------------------------------------------------------------------

def _start(mid, ts):
    return {"mid": mid, "ts": ts, "type": "startup"}


def _launches(spark, tmp_path, **kw):
    query = jobs.first_launches_exact(topics.read_folder(spark, str(tmp_path / "topics"), "startup"),
                                      str(tmp_path / "table"), once=True, **kw)
    query.awaitTermination()


def test_a_batch_reads_as_much_as_an_earlier_one_did(spark, tmp_path, put):
    seen = upkeep.seen_launches(str(tmp_path / "table" / "_seen"))
    opened = []
    for b in range(8):
        put(tmp_path / "topics", "startup", *[_start(f"m{i}", NOON + b) for i in range(30)])
        _launches(spark, tmp_path)
        opened.append(len(seen.read(spark, low="2024-01-15", high="2024-01-15").inputFiles()))
    assert len(set(opened)) == 1
    stored = tables.read_table(spark, str(tmp_path / "table"), schemas.FIRST_LAUNCH_TABLE)
    assert sorted((r.mid, r.ts) for r in stored.collect()) == sorted((f"m{i}", NOON) for i in range(30))


def test_a_table_without_a_seen_index_gets_one(spark, tmp_path, put):
    put(tmp_path / "topics", "startup", _start("a", NOON), _start("b", NOON))
    _launches(spark, tmp_path)
    files.delete(spark, str(tmp_path / "table" / "_seen"))
    put(tmp_path / "topics", "startup", _start("a", NOON + 1), _start("c", NOON + 1))
    _launches(spark, tmp_path)
    stored = tables.read_table(spark, str(tmp_path / "table"), schemas.FIRST_LAUNCH_TABLE)
    assert sorted(r.mid for r in stored.collect()) == ["a", "b", "c"]


def test_an_earlier_day_that_arrives_late_moves_the_first_day(spark, tmp_path, put):
    days = upkeep.FirstDays(str(tmp_path / "table" / "_first_days"))
    held = lambda: sorted(map(tuple, days.table.read(spark).collect()))
    put(tmp_path / "topics", "startup", _start("a", NOON), _start("b", NOON), _start("a", NOON + DAY))
    _launches(spark, tmp_path, first_days=True)
    put(tmp_path / "topics", "startup", _start("a", NOON - DAY), _start("b", NOON + DAY), _start("c", NOON))
    _launches(spark, tmp_path, first_days=True)
    want = [("a", "2024-01-14"), ("b", "2024-01-15"), ("c", "2024-01-15")]
    assert held() == want
    for lost in (tmp_path / "table" / "_checkpoint" / "commits").glob("*1*"):
        lost.unlink()
    _launches(spark, tmp_path, first_days=True)
    assert held() == want
    assert sorted(r.mid for r in days.of_day(spark, "2024-01-15").collect()) == ["b", "c"]
    assert [r.mid for r in days.of_day(spark, "2024-01-14").collect()] == ["a"]


def _order(i, amount, hour="03", day="2024-01-02"):
    return {"id": str(i), "total_amount": str(amount), "consignee_tel": "138", "create_time": f"{day} {hour}:00:00"}


def test_orders_of_a_batch_are_read_once(spark, tmp_path):
    """Their rows come from a dear plan: it runs for the write of the batch and never again."""
    path, seen = str(tmp_path / "table"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for b in range(2):
        rows = spark.createDataFrame([tuple([str(i)] + [None] * (len(schemas.ORDER_TABLE) - 1)) for i in range(30)],
                                     schemas.ORDER_TABLE).withColumns({
            "total_amount": F.lit(float(b + 1)), "create_date": F.lit("2024-01-02"), "create_hour": F.lit("03")})
        upkeep.Orders(path).apply(rows.mapInArrow(count, rows.schema), b)
        assert seen.value == 30 * (b + 1)
        assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    assert [(float(r.amount), r.orders) for r in upkeep.Orders(path).per_hour(spark).collect()] == [(60.0, 30)]
    assert upkeep.Orders(path).read(spark).count() == 30


def test_a_batch_keeps_payloads_of_rejected_orders_only(spark, tmp_path, put, monkeypatch):
    held, write = [], jobs.sinks.write_quarantine
    monkeypatch.setattr(jobs.sinks, "write_quarantine", lambda rows, *to: (
        held.extend(tuple(r) for r in rows.select("id", "_raw", "_error").collect()), write(rows, *to)))
    put(tmp_path / "topics", "order", _order(1, 1), "{broken", _order(2, "n/a"))
    jobs.ingest_orders(topics.read_folder(spark, str(tmp_path / "topics"), "order"), str(tmp_path / "table"),
                       once=True).awaitTermination()
    assert sorted((i, raw is None, e) for i, raw, e in held if i) == [("1", True, None), ("2", False, "bad_total_amount")]
    kept = tables.read_table(spark, str(tmp_path / "table" / "_quarantine"), schemas.QUARANTINE_TABLE).collect()
    assert sorted(r._error for r in kept) == ["bad_json", "bad_total_amount"] and "{broken" in [r._raw for r in kept]
    assert [r.id for r in tables.read_orders(spark, str(tmp_path / "table")).collect()] == ["1"]


def test_hours_equal_a_recount_after_updates_and_repeats(spark, tmp_path, put):
    orders = upkeep.Orders(str(tmp_path / "table"))

    def run():
        jobs.upsert_orders(topics.read_folder(spark, str(tmp_path / "topics"), "order"), str(tmp_path / "table"),
                           once=True).awaitTermination()

    def check(want):
        rows = orders.read(spark)
        again = rows.groupBy("create_date", "create_hour").agg(
            F.sum(F.col("total_amount").cast("decimal(20,2)")).cast("decimal(38,2)").alias("amount"),
            F.count("*").alias("orders"))
        found = sorted(map(tuple, orders.per_hour(spark).collect()))
        assert found == sorted(map(tuple, again.collect()))
        assert [(d, h, float(a), n) for d, h, a, n in found] == want

    put(tmp_path / "topics", "order", _order(1, 0.1), _order(2, 0.2), _order(3, 5, "04"))
    run()
    check([("2024-01-02", "03", 0.3, 2), ("2024-01-02", "04", 5.0, 1)])
    put(tmp_path / "topics", "order", _order(3, 7, "05"), _order(1, 0.3), _order(4, 1, day="2024-01-03"))
    run()  # one order moves to another hour, one changes its amount, one is new
    want = [("2024-01-02", "03", 0.5, 2), ("2024-01-02", "05", 7.0, 1), ("2024-01-03", "03", 1.0, 1)]
    check(want)
    put(tmp_path / "topics", "order", _order(4, 1, day="2024-01-03"))
    run()  # the same again changes nothing
    check(want)
    for lost in (tmp_path / "table" / "_checkpoint" / "commits").glob("*[12]*"):
        lost.unlink()
    run()
    check(want)
    assert [r.orders for r in orders.per_hour(spark, low="2024-01-03", high="2024-01-03").collect()] == [1]


def test_a_batch_of_orders_is_shuffled_once(spark, tmp_path, put, monkeypatch):
    """The shuffle that finds an order's newest message deals the orders to the table's buckets."""
    kind, dealt = type(spark.range(1)), []
    deal = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda rows, *to: dealt.append(to) or deal(rows, *to))
    table = upkeep.Orders(str(tmp_path / "table"))
    for b, amounts in enumerate(([1, 2], [5])):
        for n in amounts:
            put(tmp_path / "topics", "order", *[{**_order(i, n), "operate_time": f"2024-01-0{n} 00:00:00"} for i in range(200)])
        jobs.upsert_orders(topics.read_folder(spark, str(tmp_path / "topics"), "order"), table.path,
                           once=True).awaitTermination()
        runs = files.names(spark, f"{table.table.path}/runs")
        staged = [n for n in runs if n.startswith(f"{b:012d}")]
        assert [sum(f.endswith(".parquet") for f in files.names(spark, f"{table.table.path}/runs/{n}")) for n in staged] == [16]
        assert ("id" in [c for to in dealt for c in to]) == bool(b)  # a merge deals rows, a batch by itself does not
    assert {(r.id, r.total_amount) for r in table.read(spark).collect()} == {(str(i), 5.0) for i in range(200)}
    assert [(float(r.amount), r.orders) for r in table.per_hour(spark).collect()] == [(1000.0, 200)]
