from __future__ import annotations

import random

from pyspark.sql import functions as F

from reportmill.operators.dedup import keep_latest


def latest(df, prefer=()):
    return sorted(tuple(row) for row in keep_latest(df, ["k"], "v", prefer).collect())


def test_greatest_version_wins_and_null_version_loses(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("b", None, "n")], "k string, v int, d string")
    assert latest(df) == [("a", 2, "y"), ("b", None, "n")]


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "z")], "k string, v int, d string")
    assert sorted(row.d for row in keep_latest(df, ["k"], "v").collect()) == ["y", "z"]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("a", 1, None, "p"), ("a", 1, "p", None), ("a", 1, "q", "q"), ("a", 1, "q", "r")]
    found = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v int, d string, e string").repartition(3)
        found.add(tuple(latest(df)))
    assert found == {(("a", 1, "q", "r"),)}


def test_preferred_column_settles_ties_first(spark):
    df = spark.createDataFrame([("a", 1, "z", 0), ("a", 1, "b", 1)], "k string, v int, d string, p int")
    assert latest(df, ["p"]) == [("a", 1, "b", 1)]


def test_unorderable_columns_are_carried(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 1, {"x": 2})], "k string, v int, m map<string,int>")
    assert latest(df) == [("a", 1, {"x": 2})]


def test_columns_named_like_a_rank_survive(spark):
    df = spark.createDataFrame([("a", 1, 7), ("a", 2, 8)], "k string, v int, rank int")
    assert latest(df) == [("a", 2, 8)]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    """A third of all rows share one key; each map task ships one of them."""
    rows = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    result = keep_latest(rows, ["k"], "v")
    assert result.count() == 60_001
    assert result.where("k = -1").first().v == 89_997
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert exchange < partial
