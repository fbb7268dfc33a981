from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reportmill.functions import as_date, base_name, landing_name, month_window, plain, typed, week_start
from reportmill.operators.shape import cast_all, conform, project, rename_all
from reportmill.spec import REPORTS, ReportSpec


@pytest.fixture(params=["true", "false"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(
    "kind, text, expected",
    [
        ("int", "12", 12),
        ("int", "12.7", 12),
        ("int", "-12.7", -12),
        ("int", " 7 ", 7),
        ("int", "1e3", None),
        ("int", "12.x", None),
        ("int", "-.5", 0),
        ("int", "5.", 5),
        ("int", "12.99999999999", 12),
        ("int", "2147483647.9", 2147483647),
        ("int", "\t+7\n", 7),
        ("int", "n/a", None),
        ("int", "", None),
        ("int", "3000000000", None),
        ("int", "3000000000.5", None),
        ("int", None, None),
        ("decimal(18,5)", "1.234565", Decimal("1.23457")),
        ("decimal(18,5)", "9.5", Decimal("9.50000")),
        ("decimal(18,5)", "12345678901234567890", None),
        ("decimal(18,5)", "abc", None),
        ("timestamp", "2024-01-02T03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("timestamp", "2024-01-02", dt.datetime(2024, 1, 2)),
        ("timestamp", "2024-13-02", None),
        ("string", " kept ", " kept "),
    ],
)
def test_bad_text_is_null(spark, ansi, kind, text, expected):
    df = spark.createDataFrame([(text,)], "v string").select(typed(F.col("v"), kind).alias("v"))
    assert df.first().v == expected


def test_integers_follow_the_lenient_cast(spark):
    """The same result as Spark's non-ANSI cast of text to int."""
    texts = [
        ".5", "+.", ".", "-", "--5", "5.5.5", "1 2", "1_0", "12d", "7\xa0", "-0", "",
        "-2147483648.9", "0" * 40 + "12", "9" * 40 + ".5", "1.5e3", "\uff11", None,
    ]
    df = spark.createDataFrame([(text,) for text in texts], "v string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        rows = df.select("v", F.col("v").cast("int").alias("a"), typed(F.col("v"), "int").alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [(r.v, r.a) for r in rows] == [(r.v, r.b) for r in rows]


@pytest.mark.parametrize(
    "day", ["2024-02-07", "2024-01-01", "2023-12-31", "2024-02-29", "2024-03-03"]
)
def test_windows_match_calendar_arithmetic(spark, day):
    first, last = month_window(day)
    row = spark.range(1).select(first.alias("a"), last.alias("b"), week_start(day).alias("w")).first()
    now = dt.date.fromisoformat(day)
    monday = now - dt.timedelta(days=now.weekday())
    assert row.a == monday - dt.timedelta(weeks=4)
    assert row.b == now + dt.timedelta(days=6, weeks=4)
    assert row.w == monday


def test_windows_default_to_today(spark):
    row = spark.range(1).select(as_date().alias("d"), F.current_date().alias("t")).first()
    assert row.d == row.t


def test_object_names(spark):
    row = (
        spark.createDataFrame([(dt.date(2024, 1, 3),)], "d date")
        .select(landing_name("src", "rep", F.col("d")).alias("n"))
        .withColumn("b", base_name(F.col("n")))
        .first()
    )
    assert row.n == "src/rep/year=2024/month=01/day=03/2024-01-03.csv"
    assert row.b == "2024-01-03.csv"


def test_null_day_has_no_object_name(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(landing_name("src", "rep", F.col("d")).alias("n")).first().n is None


def test_dotted_names(spark):
    df = spark.createDataFrame([("1", "2")], "`a.b` string, c string")
    assert plain("`a.b`") == "a.b"
    assert project(df, ["`a.b`"]).columns == ["a.b"]
    assert cast_all(df, {"a.b": "int"}).first()["a.b"] == 1


def test_renames_run_in_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    assert rename_all(df, {"a": "b", "b": "c", "none": "x"}).columns == ["c", "z"]


def test_other_columns_are_dropped(spark):
    spec = ReportSpec("any")
    raw = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in (*spec.columns, "extra")))
    assert conform(raw, spec).columns == list(spec.columns)
    assert len(spec.columns) == 18


def test_family_has_eight_reports_three_with_marts():
    assert len(REPORTS) == 8
    assert [spec.report_type for spec in REPORTS if spec.mart] == ["adset", "age_gender", "region"]


def test_partition_sources_belong_to_the_key():
    with pytest.raises(ValueError):
        ReportSpec("bad", dimensions=("ad_id",))


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "bigint", "boolean", "float"])
def test_numbers_to_integers_follow_the_plain_cast(spark, kind):
    from reportmill.operators.shape import cast_all

    values = ["12345678.0", "0.0005", "-7.9", "3", "0", "1", None, "99999999"]
    numbers = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").try_cast(kind).alias("v"))
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = [r[0] for r in numbers.select(F.col("v").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert [r[0] for r in cast_all(numbers, {"v": "int"}).collect()] == plain
