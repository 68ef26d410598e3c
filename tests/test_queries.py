"""Every registered query against its SQL, on whole tables of the smallest scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    found = entry(spark)
    assert found.columns[:3] == ["request_id", "station", "distance_km"]
    assert found.count() > 0


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, name):
    _, problem = differences(spark, SF_DIR, queries()[name], SQL.get(name))
    assert problem == ""
