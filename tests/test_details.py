import json

import pytest

from storepulse.plans import regions, sale_detail


@pytest.fixture
def details(spark):
    rows = [(f"{n:03d}", "Red Bolt" if n % 2 else "nut", "M" if n % 3 else "F", 15 + n, "d1" if n < 20 else "d2")
            for n in range(30)]
    return spark.createDataFrame(
        rows, "order_detail_id string, sku_name string, user_gender string, user_age int, dt string")


def test_search_and_total(details):
    assert sale_detail.total(sale_detail.search(details, "d1", "BOLT")).first().total == 10
    assert sale_detail.total(sale_detail.search(details, "d1")).first().total == 20


def test_pages(details):
    found = sale_detail.search(details, "d1")
    ids = [r.order_detail_id for r in sale_detail.page(found, 5, 4).collect()]
    assert ids == ["005", "006", "007", "008"]
    assert [r.order_detail_id for r in sale_detail.page_after(found, "004", 4).collect()] == ids
    assert sale_detail.page_after(found, None, 1).first().order_detail_id == "000"
    assert sale_detail.page(found, 18, 4).count() == 2


def test_facets(details):
    got = {(r.facet, r.value): (r.n, round(r.share, 2)) for r in
           sale_detail.facets(sale_detail.search(details, "d1")).collect()}
    assert got == {("age", "<20"): (5, 0.25), ("age", "20-30"): (11, 0.55), ("age", ">30"): (4, 0.2),
                   ("gender", "F"): (7, 0.35), ("gender", "M"): (13, 0.65)}


def test_result_json(details):
    got = json.loads(sale_detail.result_json(sale_detail.search(details, "d1"), 1, 2).first().json)
    assert got["total"] == 20
    assert [x["order_detail_id"] for x in got["detail"]] == ["001", "002"]
    assert {o["name"]: o["value"] for o in got["stat"][0]["options"]} == {"<20": 5, "20-30": 11, ">30": 4}
    assert {o["name"]: o["value"] for o in got["stat"][1]["options"]} == {"F": 7, "M": 13}


def test_result_json_without_hits(details):
    got = json.loads(sale_detail.result_json(sale_detail.search(details, "none"), 0, 2).first().json)
    assert got == {"total": 0, "detail": [], "stat": [{"facet": "age", "options": []}, {"facet": "gender", "options": []}]}


def test_region_bands(spark):
    orders = spark.createDataFrame([(1, 99.99), (1, 0.01), (2, 650.0), (3, 10.0)],
                                   "o_custkey long, o_totalprice double")
    customer = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "c_custkey long, c_nationkey int")
    nation = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "n_nationkey int, n_name string")
    got = {r.region: (r.amount, r.band) for r in regions.region_sales(orders, customer, nation).collect()}
    assert got == {"A": (100.0, 2), "B": (650.0, 7), "C": (10.0, 1)}
