from __future__ import annotations

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from reportmill.operators import merge
from reportmill.plans.curate import curate_frame, curate_report
from reportmill.operators.merge import list_partitions, touched_partitions, union_by_name
from reportmill.operators.shape import conform
from reportmill.session import work_dir
from reportmill.sources import scan_curated, scan_partitions
from reportmill.spec import PARTITIONS
from rows import EXPECTED, INCOMING, SPEC, STORED, raw_rows, short


def files_of(target: str) -> dict[str, int]:
    found = {}
    for folder, _, names in os.walk(target.removeprefix("file:")):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[path] = os.stat(path).st_mtime_ns
    return found


@pytest.fixture
def target(spark):
    return f"{work_dir(spark)}/curated"


def test_golden_upsert(spark, target):
    curate_frame(raw_rows(spark, STORED), SPEC, target)
    untouched = {p: t for p, t in files_of(target).items() if "account=B" in p}
    for _ in range(2):
        result = curate_frame(raw_rows(spark, INCOMING), SPEC, target)
        assert short(scan_curated(spark, SPEC, target)) == EXPECTED
        assert (result.rows_read, result.rows_written) == (3, 3)
    after = files_of(target)
    assert untouched and all(after.get(path) == time for path, time in untouched.items())


def test_golden_upsert_through_the_catalog(spark, target):
    table = "golden_upsert"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    curate_frame(raw_rows(spark, STORED), SPEC, target, table)
    assert spark.table(table).count() == 3
    # A partition written behind the catalog's back is still merged, not lost.
    early = {"ad_id": "9", "date_start": "2024-02-01", "execution_date": "2024-02-02", "spend": "4"}
    curate_frame(raw_rows(spark, [early]), SPEC, target)
    late = {**early, "ad_id": "8"}
    curate_frame(raw_rows(spark, [*INCOMING, late]), SPEC, target, table)
    extra = [("A", "8", "2024-02-02 00:00:00", "4.00000"), ("A", "9", "2024-02-02 00:00:00", "4.00000")]
    assert short(spark.table(table)) == sorted(EXPECTED + extra)
    assert short(scan_curated(spark, SPEC, target)) == sorted(EXPECTED + extra)


def test_order_does_not_matter(spark):
    versions = [
        {"ad_id": ad, "execution_date": f"2024-01-0{v}", "spend": str(v)}
        for ad in ("1", "2")
        for v in (1, 2, 3)
    ]
    random.Random(0).shuffle(versions)
    batches = [versions[:2], versions[2:4], versions[4:]]
    outcomes = set()
    for order in itertools.permutations(batches):
        target = f"{work_dir(spark)}/curated"
        for batch in order:
            curate_frame(raw_rows(spark, batch), SPEC, target)
        outcomes.add(tuple(short(scan_curated(spark, SPEC, target))))
    assert outcomes == {
        (("A", "1", "2024-01-03 00:00:00", "3.00000"), ("A", "2", "2024-01-03 00:00:00", "3.00000"))
    }


def test_random_batches_match_brute_force(spark, target):
    """Three deliveries with late rows, ties, missing versions and missing key parts."""
    rng = random.Random(11)
    lowest = ""
    state: dict[tuple, tuple] = {}
    for _ in range(3):
        rows = [
            {
                "account_id": rng.choice("AB"),
                "ad_id": rng.choice([None, *"123456789"]),
                "ad_name": rng.choice([None, "n"]),
                "date_start": f"2024-01-0{rng.randint(1, 3)}",
                "execution_date": rng.choice([None, *[f"2024-02-0{d}" for d in range(1, 5)]]),
                "spend": str(rng.randint(10, 99)),
            }
            for _ in range(150)
        ]
        best: dict[tuple, tuple] = {}
        for row in rows:
            key = (row["account_id"], row["ad_id"], row["ad_name"], row["date_start"])
            best[key] = max(best.get(key, (lowest, "")), (row["execution_date"] or lowest, row["spend"]))
        for key, (version, spend) in best.items():
            if key not in state or version >= state[key][0]:
                state[key] = (version, spend)
        curate_frame(raw_rows(spark, rows), SPEC, target)
    stored = scan_curated(spark, SPEC, target).collect()
    found = {
        (r.account_id, r.ad_id, r.ad_name, str(r.date_start)[:10]): (
            str(r.execution_date)[:10] if r.execution_date else lowest, str(int(r.spend))
        )
        for r in stored
    }
    assert len(stored) == len(found) and found == state


def test_versions_compare_as_times_not_text(spark, target):
    first = {"ad_id": "1", "execution_date": "2024-01-02 23:00:00", "spend": "1"}
    older = {"ad_id": "1", "execution_date": "2024-01-02T03:04:05", "spend": "2"}
    curate_frame(raw_rows(spark, [first]), SPEC, target)
    curate_frame(raw_rows(spark, [older]), SPEC, target)
    assert [row[3] for row in short(scan_curated(spark, SPEC, target))] == ["1.00000"]


def test_incoming_wins_a_tie(spark, target):
    row = {"ad_id": "1", "execution_date": "2024-01-02", "spend": "5"}
    curate_frame(raw_rows(spark, [row]), SPEC, target)
    curate_frame(raw_rows(spark, [{**row, "spend": "4"}]), SPEC, target)
    assert [r[3] for r in short(scan_curated(spark, SPEC, target))] == ["4.00000"]


def test_no_input_writes_nothing(spark, target):
    result = curate_frame(raw_rows(spark, INCOMING[3:]), SPEC, target)
    assert result.rows_written == 0 and scan_curated(spark, SPEC, target) is None
    curate_frame(raw_rows(spark, STORED), SPEC, target)
    before = files_of(target)
    assert curate_frame(raw_rows(spark, INCOMING[3:]), SPEC, target).partitions == []
    assert files_of(target) == before


def test_a_first_load_reads_its_partitions_off_the_stored_rows(spark, target, monkeypatch):
    """The files are parsed once; a later load needs the partitions first, to know what to merge with."""
    read = []

    def spy(rows, spec):
        read.append({name.rsplit("/part-", 1)[0].split("/account=")[0] for name in rows.inputFiles()})
        return touched_partitions(rows, spec)

    monkeypatch.setattr(merge, "touched_partitions", spy)
    source = f"{work_dir(spark)}/raw"
    names = ["A", "007", "a/b"]
    rows = [{**row, "account_id": name} for row in STORED[:2] for name in names]
    raw = raw_rows(spark, [*rows, {**rows[0], "date_start": "2024-02-01"}, *INCOMING[3:]])
    raw.write.option("header", True).csv(source)
    first, again = (curate_report(spark, SPEC, source, target) for _ in range(2))
    assert [{path.split(":", 1)[1].replace("//", "") for path in paths} for paths in read] == [
        {path.removeprefix("file:")} for path in (target, source)
    ]
    expected = [*((name, "2024", "1", "2") for name in names), ("A", "2024", "2", "1")]
    assert (first.rows_read, first.rows_written) == (again.rows_read, again.rows_written) == (7, 7)
    for result in (first, again):
        assert sorted(tuple(p) for p in result.partitions) == sorted(expected)
    blank = curate_frame(raw_rows(spark, [{**rows[0], "account_id": ""}]), SPEC, f"{target}-blank")
    assert [tuple(p) for p in blank.partitions] == [(None, "2024", "1", "2")]


def test_empty_existing_folder_counts_as_no_rows(spark):
    target = work_dir(spark)
    curate_frame(raw_rows(spark, STORED), SPEC, target)
    assert scan_curated(spark, SPEC, target).count() == 3


def test_odd_account_names_survive_a_second_upsert(spark, target):
    names = ["007", "", "a/b", "x=y", "50%", "it's", "__x"]
    rows = [{"account_id": n, "ad_id": "1", "execution_date": "2024-01-02", "spend": "1"} for n in names]
    more = [{**row, "ad_id": "2"} for row in rows]
    curate_frame(raw_rows(spark, rows), SPEC, target)
    curate_frame(raw_rows(spark, more), SPEC, target)
    stored = scan_curated(spark, SPEC, target)
    assert sorted((r.account_id, r.ad_id) for r in stored.collect()) == sorted(
        (name, ad) for name in names for ad in ("1", "2")
    )


def test_odd_account_names_in_the_catalog(spark, target):
    table = "odd_accounts"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    names = ["007", "", "a/b", "x=y", "it's", "back\\slash"]
    rows = [{"account_id": n, "ad_id": "1", "execution_date": "2024-01-02", "spend": "1"} for n in names]
    curate_frame(raw_rows(spark, rows[:1]), SPEC, target, table)
    curate_frame(raw_rows(spark, rows), SPEC, target, table)
    curate_frame(raw_rows(spark, [{**r, "ad_id": "2"} for r in rows]), SPEC, target, table)
    assert sorted((r.account_id, r.ad_id) for r in spark.table(table).collect()) == sorted(
        (name, ad) for name in names for ad in ("1", "2")
    )


def test_partition_values_are_unpadded_text(spark, target):
    curate_frame(raw_rows(spark, STORED), SPEC, target)
    assert any("year=2024/month=1/day=2/" in path for path in files_of(target))
    stored = scan_curated(spark, SPEC, target)
    assert dict(stored.dtypes)["month"] == "string"


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, n int")
    assert union_by_name(a, b, ["n", "s"]).count() == 2


def daily_rows(accounts, days):
    return [
        {"account_id": a, "ad_id": "1", "date_start": d, "execution_date": d, "spend": "1"}
        for a in accounts
        for d in days
    ]


def test_only_touched_directories_are_opened(spark, target):
    rows = daily_rows("AB", [f"2024-01-{d:02d}" for d in range(1, 11)])
    curate_frame(raw_rows(spark, rows), SPEC, target)
    missing = {**rows[0], "date_start": "2031-01-01"}
    incoming = conform(raw_rows(spark, [rows[3], rows[13], missing]), SPEC)
    result = scan_partitions(spark, SPEC, target, list_partitions(touched_partitions(incoming, SPEC)))
    assert sorted((r.account, r.day) for r in result.collect()) == [("A", "4"), ("B", "4")]
    opened = {name.rsplit("/account=", 1)[1].rsplit("/", 1)[0] for name in result.inputFiles()}
    assert opened == {"A/year=2024/month=1/day=4", "B/year=2024/month=1/day=4"}
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(2 paths)" in plan
    only_missing = conform(raw_rows(spark, [missing]), SPEC)
    assert scan_partitions(spark, SPEC, target, list_partitions(touched_partitions(only_missing, SPEC))) is None


def test_touched_directories_with_odd_names(spark, target):
    names = ["a/b", "a b", "x=1", "100%", "{c}", "[d]*?", "é", "q\"u'o", None, ""]
    rows = daily_rows(names, ["2024-01-01"])
    for _ in range(2):
        curate_frame(raw_rows(spark, rows), SPEC, target)
    stored = scan_curated(spark, SPEC, target)
    # Rows without an account are dirty and never stored; a blank account is a value.
    assert sorted(r.account_id for r in stored.collect()) == sorted(n for n in names if n is not None)
    touched = list_partitions(touched_partitions(conform(raw_rows(spark, rows), SPEC), SPEC))
    assert scan_partitions(spark, SPEC, target, touched).count() == stored.count()


def test_table_and_files_agree_after_new_partitions(spark, target):
    table = "agreeing"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for days in (["2024-01-01"], [f"2024-02-{d:02d}" for d in range(1, 9)], ["2024-01-01", "2024-03-01"]):
        result = curate_frame(raw_rows(spark, daily_rows("AB", days)), SPEC, target, table)
        assert len(result.partitions) == 2 * len(days)
        assert short(spark.table(table)) == short(scan_curated(spark, SPEC, target))
    assert spark.table(table).count() == 20


def test_a_table_elsewhere_is_refused(spark, target):
    table = "elsewhere"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    curate_frame(raw_rows(spark, STORED), SPEC, target, table)
    with pytest.raises(ValueError, match="lies at"):
        curate_frame(raw_rows(spark, INCOMING), SPEC, f"{target}-other", table)
    assert scan_curated(spark, SPEC, f"{target}-other") is None


def test_upsert_writes_balanced_partitions(spark, target):
    from reportmill.operators.shape import with_partitions

    rows = with_partitions(conform(raw_rows(spark, STORED), SPEC), SPEC)
    plan = rows.hint("rebalance", *PARTITIONS)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_no_python_in_the_plan(spark, target):
    from reportmill.operators.merge import merge_versions

    curate_frame(raw_rows(spark, STORED), SPEC, target)
    stored = scan_curated(spark, SPEC, target)
    merged = merge_versions(conform(raw_rows(spark, INCOMING), SPEC), stored, SPEC)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_hot_partition_is_split_on_write(spark):
    """One account holds most rows of a day; adaptive execution spreads it over several files."""
    from reportmill.sinks.partitioned import write_partitions

    target = f"{work_dir(spark)}/hot"
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, "65536")
    try:
        rows = spark.range(0, 200_000, 1, 16).select(
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 5)).alias("account"),
            F.lit(1).alias("day"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        write_partitions(rows, target, ["account", "day"])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    written = files_of(target)
    assert sum("account=hot" in path for path in written) > 3
    assert spark.read.parquet(target).count() == 200_000
