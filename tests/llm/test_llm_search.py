import math

import pytest
from pyspark.sql import functions as F

from storepulse.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def brute(rows, queries, k):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    found = []
    for i in sorted({i for i, _ in whole if i in queries}):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for q, v in whole if q == i
                        for j, w in whole if j != i and len(w) == len(v))
        found += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return found


ROWS = [(i, [((i * 7) % 5) / 4 - 0.5, (i % 3) / 2, -0.25]) for i in range(0, 60)] + [
    (100, None), (150, [0.5, None, 0.1]), (151, [float("nan"), 0.0, 0.0]), (152, [float("inf"), 0.0, 0.0]),
    (None, [9.0, 9.0, 9.0]), (50, [0.0, 0.0, 0.0]), (7, [0.25, 0.5, -0.25]), (7, [0.25, 0.5, -0.25]),
    (200, [1.0, 2.0]), (250, [0.5, 0.5]), (300, []), (350, [1.0]), (400, [1e9, 1e9, 1e9])]


@pytest.mark.parametrize("k,shard,block", [(5, 8192, 1024), (3, 7, 2), (100, 16, 3)])
def test_equals_brute_force(spark, k, shard, block):
    rows = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in ROWS], SCHEMA).repartition(5)
    wanted = rows.filter(F.col("vec_id") % 50 == 0)
    found = topk.top_k(rows, wanted, k=k, shard_rows=shard, block_rows=block, fan=2)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(ROWS, {i for i, _ in ROWS if i is not None and i % 50 == 0}, k)


def test_every_row_but_the_querys_own_is_a_candidate(spark):
    rows = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (1, [5.0]), (2, [2.0]), (0, [9.0])] + [(3, [4.0])] * 9,
                                 "vec_id long, embedding array<float>").repartition(3)
    found = topk.top_k(rows, rows.filter("vec_id = 0").filter("embedding[0] = 1"), k=4)
    assert [tuple(r) for r in found.orderBy("rank").collect()] == [
        (0, 1, 1, 327680), (0, 2, 3, 262144), (0, 3, 3, 262144), (0, 4, 3, 262144)]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(none, none).count() == 0


def test_large_numbers_are_exact():
    import numpy as np
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**40, 5.0], [-1.0, 2.0**52]])
    assert topk.products(a, b).tolist() == [[2**63 - 1, 3 * 2**52 - 2**40]]
