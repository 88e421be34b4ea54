import pytest

import __spark_entry__ as registry
import oracle
from conftest import SF_DIR

SQL = registry.oracle_sql()
QUERIES = registry.queries()
OWN = [q.__name__ for q in registry.QUERIES]


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    columns, rows, ours, theirs = oracle.compare(spark, db, QUERIES[name], SQL[name], SF_DIR)
    assert columns
    assert rows, (len(ours), len(theirs), ours[:3], theirs[:3])


def test_entry(spark):
    assert sum(r.ct for r in registry.entry(spark).collect()) == 11
