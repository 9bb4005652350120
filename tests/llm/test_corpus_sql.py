"""Queries against their SQL, where SQL can say the same."""

import pytest
from compare import connect, spark_rows, sql_rows

from tillsight.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def test_all_operators_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, name):
    found, expected = spark_rows(QUERIES[name](spark, SF)), sql_rows(connect(SF), ORACLE[name])
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    assert sum(found[1].values()) > 0
