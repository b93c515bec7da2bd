"""The operators' queries against their SQL on the smallest tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, difference
from tests.llm.helpers import SF_DIR
from tidemart.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) is None


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())
