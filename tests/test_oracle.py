"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, in_utc
from compare import connect, spark_rows, sql_rows, type_family
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = in_utc(QUERIES[name])(spark, SF_DIR)
    names, rows = spark_rows(result)
    expected_names, expected = sql_rows(duck, ORACLE[name])
    assert names == expected_names
    missing, extra = expected - rows, rows - expected
    assert not missing and not extra, (
        sum(rows.values()), sum(expected.values()), list(missing)[:2], list(extra)[:2]
    )
    assert sum(rows.values()) > 0
    described = duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    sql_types = {row[0]: type_family(row[1]) for row in described}
    assert {n: type_family(t) for n, t in result.dtypes} == sql_types


def test_entry_is_stable(spark):
    result = entry(spark)
    assert result.count() > 0
    assert result.schema == entry(spark).schema
