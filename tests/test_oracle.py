"""Every registered query against its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["Status"] for r in rows} == {"F", "N", "O", "X"}
