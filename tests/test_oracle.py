"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from workload import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in entry_points.queries().items() if name in queries.ALL}
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(queries.ALL) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() == 834
