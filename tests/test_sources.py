from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from reportmill.plans.curate import curate_report
from reportmill.session import session_conf, shared_dir, work_dir
from reportmill.sources import report_path, scan_curated, scan_delimited, scan_delimited_groups
from reportmill.streaming.incremental import curate_new_files
from rows import EXPECTED, INCOMING, SPEC, STORED, raw_rows, short

TIB = 1 << 40


def write_file(path: str, text: str) -> None:
    path = path.removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as handle:
        handle.write(text)


def test_scan_is_recursive_and_untyped(spark):
    root = work_dir(spark)
    write_file(f"{root}/a/x.csv", "id,v\n007,1\n")
    write_file(f"{root}/a/b/c/y.csv", 'id,v\n008,"1,5"\n')
    rows = scan_delimited(spark, root)
    assert {t for _, t in rows.dtypes} == {"string"}
    assert sorted(tuple(r) for r in rows.collect()) == [("007", "1"), ("008", "1,5")]


def test_permuted_headers_fail_rather_than_shift(spark):
    root = work_dir(spark)
    write_file(f"{root}/x.csv", "id,v\n1,2\n")
    write_file(f"{root}/y.csv", "v,id\n3,4\n")
    with pytest.raises(Exception, match="header does not conform"):
        scan_delimited(spark, root).collect()


def test_header_groups_match_by_name(spark):
    root = work_dir(spark)
    write_file(f"{root}/1/x.csv", "id,v\n1,2\n")
    write_file(f"{root}/2/y.csv", "w,v,id\n9,4,3\n")
    rows = scan_delimited_groups(spark, [f"{root}/1", f"{root}/2"])
    assert sorted(((r.id, r.v, r.w) for r in rows.collect())) == [("1", "2", None), ("3", "4", "9")]


def test_report_path():
    assert report_path("/lake/", "web", "country") == "/lake/web/country/"


def test_other_read_errors_are_not_hidden(spark):
    root = work_dir(spark)
    write_file(f"{root}/x.parquet", "this is not parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        scan_curated(spark, SPEC, root).collect()


def test_only_needed_columns_are_read(spark):
    root = work_dir(spark)
    raw_rows(spark, STORED).write.option("header", True).csv(f"{root}/raw")
    curate_report(spark, SPEC, f"{root}/raw", f"{root}/curated")
    picked = scan_curated(spark, SPEC, f"{root}/curated").where("account = 'A'").select("ad_id", "spend")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ad_id:string,spend:decimal(18,5)>" in plan
    assert "PartitionFilters: [isnotnull(account" in plan


def test_dirty_rows_are_filtered_at_the_scan(spark):
    from reportmill.operators.filters import drop_dirty, in_month_window
    from reportmill.operators.shape import conform

    root = work_dir(spark)
    raw_rows(spark, STORED).write.option("header", True).csv(f"{root}/raw")
    clean = drop_dirty(conform(scan_delimited(spark, f"{root}/raw"), SPEC), SPEC)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(account_id)" in plan and "IsNotNull(date_start)" in plan
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    window = in_month_window(events, "ts", "2024-02-07")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_each_file_is_curated_once(spark):
    root = work_dir(spark)
    paths = [f"{root}/{name}" for name in ("raw", "curated", "checkpoint")]

    def land(rows, name):
        raw_rows(spark, rows).coalesce(1).write.option("header", True).csv(f"{paths[0]}/{name}")

    land(STORED, "first")
    curate_new_files(spark, SPEC, *paths)
    # A later run must not read the first files again: their rows would come back.
    curated = scan_curated(spark, SPEC, paths[1]).where("account = 'B'")
    assert curated.count() == 1
    land(INCOMING, "second")
    curate_new_files(spark, SPEC, *paths, maxFilesPerTrigger=1)
    assert short(scan_curated(spark, SPEC, paths[1])) == EXPECTED
    offsets = os.listdir(f"{paths[2].removeprefix('file:')}/commits")
    curate_new_files(spark, SPEC, *paths)
    assert os.listdir(f"{paths[2].removeprefix('file:')}/commits") == offsets


def test_new_files_go_into_the_catalog_table(spark):
    root = work_dir(spark)
    paths = [f"{root}/{name}" for name in ("raw", "curated", "checkpoint")]
    spark.sql("DROP TABLE IF EXISTS arrivals")
    for name, rows in {"first": STORED, "second": INCOMING}.items():
        raw_rows(spark, rows).coalesce(1).write.option("header", True).csv(f"{paths[0]}/{name}")
        schema = raw_rows(spark, rows).schema
        curate_new_files(spark, SPEC, *paths, table="arrivals", schema=schema)
    assert short(spark.table("arrivals")) == EXPECTED


def test_listing_partitions_reads_two_columns(spark):
    from reportmill.operators.filters import drop_dirty
    from reportmill.operators.merge import touched_partitions
    from reportmill.operators.shape import conform

    root = work_dir(spark)
    raw_rows(spark, STORED).write.option("header", True).csv(f"{root}/raw")
    clean = drop_dirty(conform(scan_delimited(spark, f"{root}/raw"), SPEC), SPEC)
    plan = touched_partitions(clean, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<account_id:string,date_start:string>" in plan


def test_session_settings_follow_the_data():
    small, large = session_conf(1 << 20, 8), session_conf(100 * TIB, 8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) == 100 * TIB // (256 << 20)
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 100 * TIB // 100_000
    other = session_conf(100 * TIB, 8000, split_bytes=1 << 29, reducer_bytes=1 << 30)
    assert int(other["spark.sql.shuffle.partitions"]) == 100 * TIB // (1 << 30)
    assert int(other["spark.sql.files.maxPartitionBytes"]) == 1 << 29


def test_work_dirs_are_new_and_shared(spark):
    first, second = work_dir(spark), work_dir(spark)
    assert first != second
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) in first
    assert spark.range(1).select(F.lit(first)).first()[0] == first


def test_quoted_text_is_read_as_written(spark):
    root = work_dir(spark)
    os.makedirs(f"{root.removeprefix('file:')}/raw")
    lines = ["id,text,n", '1,"a ""b"", c",9', '2,"say ""hi""",8', '3,"back\\",7', "4, plain ,6"]
    with open(f"{root.removeprefix('file:')}/raw/a.csv", "w") as handle:
        handle.write("\n".join(lines) + "\n")
    rows = [tuple(r) for r in scan_delimited(spark, f"{root}/raw").collect()]
    assert rows == [("1", 'a "b", c', "9"), ("2", 'say "hi"', "8"), ("3", "back\\", "7"), ("4", " plain ", "6")]


def test_sources_without_files_change_nothing(spark):
    from reportmill.plans.curate import curate_report

    root = work_dir(spark)
    paths = [f"{root}/{name}" for name in ("raw", "curated", "checkpoint")]
    for _ in range(2):  # first without the folder, then with an empty one
        result = curate_report(spark, SPEC, paths[0], paths[1])
        assert (result.rows_read, result.rows_written, result.partitions) == (0, 0, [])
        curate_new_files(spark, SPEC, *paths)
        assert scan_curated(spark, SPEC, paths[1]) is None
        os.makedirs(f"{paths[0].removeprefix('file:')}/sub", exist_ok=True)
    raw_rows(spark, STORED).coalesce(1).write.option("header", True).csv(f"{paths[0]}/sub/first")
    curate_new_files(spark, SPEC, *paths)
    before = short(scan_curated(spark, SPEC, paths[1]))
    curate_report(spark, SPEC, f"{root}/nothing", paths[1])
    assert before and short(scan_curated(spark, SPEC, paths[1])) == before


def test_format_options_hold_for_the_header_of_new_files(spark):
    root = work_dir(spark)
    paths = [f"{root}/{name}" for name in ("raw", "curated", "checkpoint")]
    raw_rows(spark, STORED).coalesce(1).write.options(header=True, sep=";").csv(f"{paths[0]}/first")
    curate_new_files(spark, SPEC, *paths, sep=";")
    assert scan_curated(spark, SPEC, paths[1]).count() == 3
