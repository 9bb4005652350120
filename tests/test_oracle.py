"""Every registered query against its SQL, on the tables the driver checks."""

import os

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as contract

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# The corpus operators have tests of their own.
QUERIES, SQL = contract.QUERIES, contract.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    rows = contract.entry(spark).groupBy("patternId").count().collect()
    assert {r["patternId"]: r["count"] for r in rows} == {"PatId1": 18, "PatId2": 3, "PatId3": 5}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    found, expected = spark_rows(QUERIES[name](spark, SF)), sql_rows(con, SQL[name])
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    assert sum(found[1].values()) > 0
