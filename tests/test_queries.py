"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry
from tidemart.checks import load_all
from tests.compare import connect, difference

QUERIES, SQL = load_all()
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    sql = SQL.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, duck, sql) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
