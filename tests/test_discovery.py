"""Partitions and columns that others wrote show in the catalog table."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from reportmill.session import work_dir
from reportmill.sinks.catalog import register_table
from reportmill.sinks.discovery import discover

KEYS = ("account", "day")


@pytest.fixture
def place(spark):
    root = work_dir(spark)
    name, path = f"discovered_{root[-8:]}", f"{root}/rows"
    rows = spark.createDataFrame([(1, "007", "1"), (2, "8", "2")], "n int, account string, day string")
    rows.write.partitionBy(*KEYS).parquet(path)
    register_table(spark, name, path, rows.schema, KEYS)
    return name, path


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("append").partitionBy(*KEYS).parquet(path)


def test_foreign_partitions_and_columns_show(spark, place):
    name, path = place
    add(spark, path, [(3, "x", "007", "3"), (4, None, "007", "1")], "n int, `odd name` string, account string, day string")
    assert spark.table(name).columns == ["n", "account", "day"]
    assert discover(spark, name, path, KEYS) == ["odd name"]
    got = {(r["n"], r["odd name"], r["account"], r["day"]) for r in spark.table(name).collect()}
    assert got == {(1, None, "007", "1"), (2, None, "8", "2"), (3, "x", "007", "3"), (4, None, "007", "1")}
    assert discover(spark, name, path, KEYS) == [] and spark.table(name).count() == 4


def test_only_new_files_are_read_for_columns(spark, place):
    name, path = place
    add(spark, path, [(3, 1.5, "9", "3")], "n int, rate double, account string, day string")
    assert discover(spark, name, path, KEYS, since="2100-01-01T00:00:00") == []
    assert spark.table(name).columns == ["n", "account", "day"] and spark.table(name).count() == 3
    assert discover(spark, name, path, KEYS, since="2000-01-01T00:00:00") == ["rate"]


def test_contradicting_types_leave_the_table_as_it_was(spark, place):
    name, path = place
    add(spark, path, [("a", "9", "4")], "N string, account string, day string")
    with pytest.raises(Exception, match="(?i)merge"):  # Spark's own error, from the tasks that read footers
        discover(spark, name, path, KEYS)
    assert spark.table(name).columns == ["n", "account", "day"] and spark.table(name).count() == 2


def test_types_of_the_table_hold(spark, place):
    name, path = place
    spark.sql(f"CREATE TABLE {name}_wide (n bigint, account string, day string) USING parquet PARTITIONED BY (account, day) LOCATION '{path}'")
    with pytest.raises(ValueError, match="n is int"):
        discover(spark, f"{name}_wide", path, KEYS)
    assert spark.table(f"{name}_wide").count() == 0


def test_missing_folder_is_an_error(spark, place):
    name, path = place
    with pytest.raises(ValueError):
        discover(spark, name, path + "_elsewhere", KEYS)
    spark.sql(f"CREATE TABLE {name}_lost (n int, account string, day string) USING parquet PARTITIONED BY (account, day) LOCATION '{path}_lost'")
    with pytest.raises(AnalysisException):
        discover(spark, f"{name}_lost", f"{path}_lost", KEYS)
