"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import SF_DIR

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_oracles  # noqa: E402

registry = check_oracles.registry
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_each_query_of_the_log_has_sql():
    assert SQL.keys() <= QUERIES.keys()
    assert registry._own_queries().keys() <= SQL.keys()


@pytest.fixture(scope="module")
def duck():
    return check_oracles.connect(SF_DIR)


@pytest.mark.parametrize("name", registry._own_queries())
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert check_oracles.same_rows(got, duck.execute(SQL[name]).df()) == ""
