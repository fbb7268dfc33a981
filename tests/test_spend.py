from __future__ import annotations

import csv
import datetime as dt
import glob
import itertools
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reportmill.operators.media import outer_join_on
from reportmill.plans.spend import spend_summary, summarize_spend
from reportmill.session import work_dir
from reportmill.sinks.export import export_sorted, land_by_day

STREAMING = {
    "streaming": {"2024-01-01": {"spend": 10.0}, "2024-01-02": {"spend": 5.0}},
    "audio": {"2024-01-02": {"spend": 2.5}},
}
LINEAR = {"weekSummary": [{"day": "2024-01-03", "electronic": 7.0}]}
GOLDEN = [
    ("2024-01-01", 10.0, None, None),
    ("2024-01-02", 5.0, 2.5, None),
    ("2024-01-03", None, None, 7.0),
]


def documents(spark, *payloads):
    return spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "value string")


def summary(spark, streaming, linear):
    return summarize_spend(documents(spark, streaming), documents(spark, linear))


def local(path: str) -> str:
    return path.removeprefix("file:")


def csv_rows(path: str) -> list[list[str]]:
    rows = []
    for name in sorted(glob.glob(f"{local(path)}/*.csv")):
        with open(name) as handle:
            content = list(csv.reader(handle))
        rows += content if not rows else content[1:]
    return rows


def test_golden_summary(spark):
    result = summary(spark, STREAMING, LINEAR)
    assert result.columns == ["Date", "Streaming Video", "Streaming Audio", "Linear TV"]
    assert sorted(tuple(r) for r in result.collect()) == GOLDEN


def test_summary_reads_landed_files_and_replaces_the_day(spark):
    root = work_dir(spark)
    paths = {}
    for name, payload in {"streaming": STREAMING, "linear": LINEAR}.items():
        paths[name] = f"{root}/{name}"
        os.makedirs(local(paths[name]))
        with open(f"{local(paths[name])}/payload.json", "w") as handle:
            json.dump(payload, handle, indent=2)
    for _ in range(2):
        landed = spend_summary(
            spark, paths["streaming"], paths["linear"], f"{root}/out", "media", dt.date(2024, 1, 3)
        )
    assert landed.endswith("/media/spend_summary/year=2024/month=01/day=03")
    assert csv_rows(landed) == [
        ["Date", "Streaming Video", "Streaming Audio", "Linear TV"],
        ["2024-01-01", "10.0", "", ""],
        ["2024-01-02", "5.0", "2.5", ""],
        ["2024-01-03", "", "", "7.0"],
    ]


@pytest.mark.parametrize(
    "streaming, linear",
    [
        ({"streaming": {}}, LINEAR),
        ({**STREAMING, "display": {}}, LINEAR),
        ({"streaming": {}, "radio": {}}, LINEAR),
        (STREAMING, {**LINEAR, "message": "x"}),
        (STREAMING, {}),
        ("not json", LINEAR),
    ],
)
def test_incomplete_payload_fails_the_run(spark, streaming, linear):
    with pytest.raises(PySparkException, match="incomplete payload"):
        summary(spark, streaming, linear).collect()


def test_missing_documents_fail_the_run(spark):
    root = work_dir(spark)
    for name in ("streaming", "linear"):
        os.makedirs(f"{local(root)}/{name}")
    with pytest.raises(ValueError):
        spend_summary(spark, f"{root}/streaming", f"{root}/linear", f"{root}/out", "media")


def test_empty_medium_gives_no_rows(spark):
    result = summary(spark, {"streaming": {}, "audio": {}}, LINEAR)
    assert [tuple(r) for r in result.collect()] == [GOLDEN[2]]


@pytest.mark.parametrize("hot_keys", [False, True])
def test_outer_join_against_brute_force(spark, hot_keys):
    """Duplicate keys multiply, null keys match, absent sides are null."""
    left = [("a", 1), ("a", 2), (None, 3), ("b", 4)]
    right = [("a", 5), ("a", 6), (None, 7), ("c", 8)]
    result = outer_join_on(
        spark.createDataFrame(left, "k string, `x 1` int"), spark.createDataFrame(right, "k string, y int"),
        "k", hot_keys,
    )
    expected = [(lk, lv, rv) for (lk, lv), (rk, rv) in itertools.product(left, right) if lk == rk]
    expected += [(k, v, None) for k, v in left if k not in [r[0] for r in right]]
    expected += [(k, None, v) for k, v in right if k not in [r[0] for r in left]]
    key = lambda row: tuple(str(v) for v in row)
    assert sorted((tuple(r) for r in result.collect()), key=key) == sorted(expected, key=key)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_key_of_an_outer_join_is_split(spark):
    """Half of the left rows share a date; adaptive execution splits their partition."""
    hot = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string"))
    left = spark.range(0, 200_000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    right = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("w")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "262144",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1048576",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        result = outer_join_on(left, right, "k", hot_keys=True)
        rows = result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # 100,000 hot and 100,000 odd left rows all match; the even right keys but 0 do not.
    assert len(rows) == 200_000 + 99_999
    assert sum(row.k == "hot" for row in rows) == 100_000
    assert "SortMergeJoin(skew=true)" in plan


def test_export_is_sorted_with_nulls_last_in_one_small_file(spark):
    path = f"{work_dir(spark)}/export"
    rows = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "Date string, n int").repartition(3)
    export_sorted(rows, path, "Date")
    assert csv_rows(path) == [["Date", "n"], ["a", "3"], ["b", "1"], ["", "2"]]
    assert len(glob.glob(f"{local(path)}/*.csv")) == 1


def test_export_spreads_a_hot_value(spark):
    """Two thirds of the rows share a date and are equal; no file may hold them all."""
    path = f"{work_dir(spark)}/hot"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        day = F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("5")
        export_sorted(spark.range(0, 30_000, 1, 8).select(day.alias("Date")), path, "Date")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    rows = csv_rows(path)[1:]
    assert rows == sorted(rows) and len(rows) == 30_000
    sizes = [sum(1 for _ in open(name)) for name in glob.glob(f"{local(path)}/*.csv")]
    assert max(sizes) < 10_000


def test_landing_directories_are_padded(spark):
    path = f"{work_dir(spark)}/landing"
    rows = spark.createDataFrame([(dt.date(2024, 1, 3), 1), (dt.date(2024, 11, 12), 2)], "d date, n int")
    land_by_day(rows, path, "d")
    assert os.path.isdir(f"{local(path)}/year=2024/month=01/day=03")
    assert os.path.isdir(f"{local(path)}/year=2024/month=11/day=12")
    land_by_day(rows.limit(1).selectExpr("d", "n + 10 as n"), path, "d")
    read = spark.read.option("header", True).csv(path)
    assert sorted(int(r.n) for r in read.collect()) in ([2, 11], [1, 12])


def test_newest_delivery_counts_per_medium_and_date(spark):
    root = work_dir(spark)
    deliveries = [
        ({"streaming": {"2024-01-01": {"spend": 1.0}, "2024-01-02": {"spend": 2.0}}, "audio": {}}, [("2024-01-03", 3.0)]),
        ({"streaming": {"2024-01-02": {"spend": 9.0}}, "audio": {"2024-01-01": {"spend": 4.0}}}, [("2024-01-03", 5.0), ("2024-01-03", 7.0)]),
    ]
    for number, (streaming, linear) in enumerate(deliveries):
        weeks = {"weekSummary": [{"day": d, "electronic": v} for d, v in linear]}
        for name, payload in (("streaming", streaming), ("linear", weeks)):
            os.makedirs(f"{local(root)}/{name}", exist_ok=True)
            path = f"{local(root)}/{name}/{9 - number}.json"
            with open(path, "w") as handle:
                json.dump(payload, handle)
            os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    landed = spend_summary(spark, f"{root}/streaming", f"{root}/linear", f"{root}/out", "media", dt.date(2024, 1, 9))
    assert csv_rows(landed)[1:] == [["2024-01-01", "1.0", "4.0", ""], ["2024-01-02", "9.0", "", ""], ["2024-01-03", "", "", "7.0"]]
    assert [os.path.basename(p) for p in glob.glob(f"{local(landed)}/*.csv")] == ["2024-01-09-00000.csv"]


def test_last_value_of_a_repeated_key_counts(spark):
    repeated = '{"streaming": {"2024-01-01": {"spend": 1.0}, "2024-01-02": {"spend": 2.0}, "2024-01-01": {"spend": 3.0}}, "audio": {}}'
    rows = summary(spark, repeated, LINEAR).where("`Streaming Video` IS NOT NULL").collect()
    assert sorted((r[0], r[1]) for r in rows) == [("2024-01-01", 3.0), ("2024-01-02", 2.0)]


def test_exports_read_back_as_they_were(spark):
    from reportmill.sources import scan_delimited

    path = f"{work_dir(spark)}/exact"
    rows = spark.sql("""SELECT * FROM VALUES (1, ' a "b", c ', timestamp'2024-01-02 03:04:05.123456'),
        (2, 'back\\\\', timestamp'2024-01-02 00:00:00') AS t(id, text, ts)""")
    export_sorted(rows, path, "id")
    read = [tuple(r) for r in scan_delimited(spark, path).collect()]
    assert read == [("1", ' a "b", c ', "2024-01-02 03:04:05.123456"), ("2", "back\\", "2024-01-02 00:00:00.000000")]
    days = f"{work_dir(spark)}/days"
    land_by_day(rows, days, "ts")
    names = [os.path.basename(p) for p in glob.glob(f"{local(days)}/*/*/*/*.csv")]
    assert names and all(n.startswith("2024-01-02-0000") for n in names)
