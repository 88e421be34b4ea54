import re

import pytest
from pyspark.sql import functions as F

from storepulse.plans import sale_detail
from storepulse.plans.detail_store import DetailStore, grams_of
from storepulse.sources import files

SHAPE = "order_detail_id string, sku_name string, user_gender string, user_age int, dt string"


def _rows(n, day, name=lambda i: ["Red Bolt", "red  nut", "RE", "é", None, ""][i % 6]):
    return [(f"{i:04d}", name(i), "M" if i % 3 else "F", 15 + i % 30, day) for i in range(n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = _rows(500, "2024-01-15") + _rows(40, "2024-01-16") + _rows(7, "2024-02-01") + _rows(3, None)
    store = DetailStore(str(tmp_path_factory.mktemp("details")), spark.createDataFrame([], SHAPE).schema, rows_per_file=60)
    assert store.load(spark.createDataFrame(rows, SHAPE).orderBy(F.rand(1))) == ["2024-01-15", "2024-01-16", "2024-02-01"]
    return store, rows


def _want(rows, day, keyword):
    return sorted(r[0] for r in rows if r[4] == day and (not keyword or keyword.lower() in (r[1] or "").lower()
                                                         and r[1] is not None))


@pytest.mark.parametrize("keyword", [None, "", "RED B", "re", "é", "d  n", "dbolt", "%"])
def test_answers_equal_a_scan(spark, stored, keyword):
    store, rows = stored
    for day in ("2024-01-15", "2024-02-01", "2030-01-01"):
        want = _want(rows, day, keyword)
        assert store.total(spark, day, keyword).first().total == len(want)
        for literals in (0, 1000):
            assert sum(r.n for r in store.hits(spark, day, keyword, literals).collect()) == len(want)
        assert sorted(r.order_detail_id for r in store.search(spark, day, keyword).collect()) == want
    want = _want(rows, "2024-01-15", keyword)
    for offset, size in ((0, 10), (55, 10), (len(want) - 3, 10), (499, 5), (10_000, 5)):
        got = [r.order_detail_id for r in store.page(spark, "2024-01-15", max(offset, 0), size, keyword).collect()]
        assert got == want[max(offset, 0):max(offset, 0) + size]


def _opened(frame):
    return {re.search(r"part=\d+", f).group() for f in
            {r.f for r in frame.select(F.input_file_name().alias("f")).collect()}}


def test_a_deep_page_reads_one_or_two_files(spark, stored):
    store, _ = stored
    assert len(list(store.hits(spark, "2024-01-15").collect())) >= 8
    for offset in (0, 100, 250, 480):
        page = store.page(spark, "2024-01-15", offset, 10)
        listed = re.search(r"part#\d+ (?:IN|INSET) \(?([\d,]+)|part#\d+ = (\d+)", page._jdf.queryExecution().executedPlan().toString())
        assert listed and (listed.group(2) or listed.group(1).count(",") <= 1)
    assert "month#" in page._jdf.queryExecution().executedPlan().toString()


def test_a_rare_keyword_reads_the_files_of_its_rows(spark, tmp_path):
    rows = _rows(400, "2024-01-15", lambda i: "golden hinge" if i == 321 else f"item {i}")
    store = DetailStore(str(tmp_path), spark.createDataFrame([], SHAPE).schema, rows_per_file=50)
    store.load(spark.createDataFrame(rows, SHAPE))
    assert store.hits(spark, "2024-01-15", "N HIN").count() == 1
    assert [r.order_detail_id for r in store.search(spark, "2024-01-15", "golden").collect()] == ["0321"]
    assert len(_opened(store.search(spark, "2024-01-15", "golden"))) == 1


def test_a_day_loaded_again_is_replaced(spark, tmp_path):
    store = DetailStore(str(tmp_path), spark.createDataFrame([], SHAPE).schema, rows_per_file=10)
    store.load(spark.createDataFrame(_rows(30, "2024-01-15") + _rows(5, "2024-01-16"), SHAPE))
    # A load that fails before the days are named changes nothing.
    before = store.days(spark)
    with pytest.raises(Exception):
        store.load(spark.createDataFrame(_rows(9, "2024-01-15"), SHAPE).withColumn(
            "sku_name", F.when(F.col("order_detail_id") == "0003", F.raise_error(F.lit("broken"))).otherwise("x")))
    assert store.days(spark) == before
    store.load(spark.createDataFrame(_rows(12, "2024-01-15"), SHAPE))
    store.forget(spark)
    assert store.total(spark, "2024-01-15").first().total == 12
    assert store.total(spark, "2024-01-16").first().total == 5
    assert set(files.names(spark, f"{tmp_path}/versions")) == set(store.days(spark).values())
    store.load(spark.createDataFrame(_rows(12, "2024-01-16"), SHAPE))
    store.forget(spark)
    assert len(files.names(spark, f"{tmp_path}/versions")) == 2
    assert store.load(spark.createDataFrame([], SHAPE)) == []


def test_document_from_a_stored_page(spark, stored):
    store, _ = stored
    found, rows = store.search(spark, "2024-01-15", "red"), store.page(spark, "2024-01-15", 7, 3, "red")
    assert sale_detail.result_json(found, 7, 3, rows).first() == sale_detail.result_json(found, 7, 3).first()


def test_runs_of_a_text(spark):
    got = spark.createDataFrame([("abca",), ("a",), ("",), (None,), ("éa",)], "s string").select(grams_of(F.col("s"))).collect()
    assert [None if r[0] is None else sorted(r[0]) for r in got] == [
        ["a", "ab", "abc", "b", "bc", "bca", "c", "ca"], ["a"], [], None, ["a", "é", "éa"]]
