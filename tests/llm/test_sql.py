"""The registered document queries against their SQL."""

from __future__ import annotations

import os

import pytest

from compare import connect, spark_rows, sql_rows, type_family
from reportmill.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = connect(SF_DIR)
    result = QUERIES[name](spark, SF_DIR)
    names, rows = spark_rows(result)
    expected_names, expected = sql_rows(duck, ORACLE[name])
    assert names == expected_names and rows == expected and rows
    described = duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert {n: type_family(t) for n, t in result.dtypes} == {row[0]: type_family(row[1]) for row in described}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_rows(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert "doc_id" in result.columns and result.count() > 0
