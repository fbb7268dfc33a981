"""Switched partitions, pruned scans, and marts that follow the loads."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reportmill.operators import versioned
from reportmill.operators.filters import drop_dirty
from reportmill.operators.marts import build_mart, build_monitoring
from reportmill.operators.merge import touched_partitions
from reportmill.operators.shape import conform
from reportmill.operators.versioned import upsert_versioned
from reportmill.plans.family import run_family
from reportmill.plans.refresh import ON_DAY, refresh_mart, refresh_monitoring, refresh_report
from reportmill.session import materialize, work_dir
from reportmill.sinks import versions
from reportmill.sources import curated as curated_source
from reportmill.sources import report_path
from reportmill.sources.curated import escape_name, scan_touched
from reportmill.spec import PARTITIONS, REPORTS
from rows import EXPECTED, INCOMING, SPEC, STORED, raw_rows, short


def clean(spark, rows, spec=SPEC):
    return drop_dirty(conform(raw_rows(spark, rows), spec), spec)


@pytest.fixture
def place(spark):
    root = work_dir(spark)
    return f"versioned_{root[-8:]}", f"{root}/curated"


def daily(accounts, days, spend="1", version="2024-05-01"):
    return [{"account_id": a, "ad_id": "1", "date_start": d, "execution_date": version, "spend": spend} for a in accounts for d in days]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_golden_upsert(spark, place):
    upsert_versioned(clean(spark, STORED), SPEC, *place)
    for _ in range(2):
        result = upsert_versioned(clean(spark, INCOMING), SPEC, *place)
        assert (result.rows_read, result.rows_written, len(result.partitions)) == (3, 3, 1)
        assert short(spark.table(place[0])) == EXPECTED
    assert upsert_versioned(clean(spark, INCOMING[3:]), SPEC, *place).partitions == []
    assert versions.remove_unused(spark, *place, older_than_hours=0) == 2
    assert versions.remove_unused(spark, *place, older_than_hours=0) == 0
    assert short(spark.table(place[0])) == EXPECTED


def test_odd_accounts(spark, place):
    names = ["007", "", "a/b", "x=y", "50%", "it's", "__x", "{c}", "[d]*?", "é", "q\"u'o", "back\\slash", "a b"]
    rows = [{"account_id": n, "ad_id": "1", "execution_date": "2024-01-02", "spend": "1"} for n in names]
    for ad in ("1", "2", "1"):
        upsert_versioned(clean(spark, [{**row, "ad_id": ad} for row in rows]), SPEC, *place)
    found = Counter((r.account_id, r.ad_id) for r in spark.table(place[0]).collect())
    assert found == Counter((n, ad) for n in names for ad in ("1", "2"))


def test_directory_names_are_those_of_the_writer(spark):
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    values = [*map(chr, range(1, 300)), "a/b=c%", "", None]
    assert all(f"k={escape_name(v)}" == names.getPartitionPathString("k", v) for v in values)


@pytest.mark.parametrize("step", ["write", "mark", "switch", "unmark"])
def test_a_load_that_dies_leaves_the_table_whole(spark, place, monkeypatch, step):
    table, root = place
    upsert_versioned(clean(spark, STORED), SPEC, table, root)
    before = short(spark.table(table))

    def die(*args):
        raise KeyboardInterrupt(step)

    with monkeypatch.context() as patch:
        if step == "write":
            broken = clean(spark, INCOMING).withColumn("campaign_name", F.raise_error(F.lit("write")).cast("string"))
            with pytest.raises(Exception, match="write"):
                upsert_versioned(broken, SPEC, table, root)
        else:
            patch.setattr(versions, step, die)
            with pytest.raises(KeyboardInterrupt):
                upsert_versioned(clean(spark, INCOMING), SPEC, table, root)
    assert short(spark.table(table)) == (EXPECTED if step == "unmark" else before)
    # The next load, of other rows, first finishes what was complete.
    late = daily("C", ["2024-03-01"])
    upsert_versioned(clean(spark, late), SPEC, table, root)
    more = [("C", "1", "2024-05-01 00:00:00", "1.00000")]
    done = EXPECTED if step in ("switch", "unmark") else before
    assert short(spark.table(table)) == sorted(done + more)
    assert versions.pending(spark, root) == []


def test_a_load_that_dies_while_switching_is_finished(spark, place, monkeypatch):
    table, root = place
    upsert_versioned(clean(spark, daily("AB", ["2024-01-01", "2024-01-02"])), SPEC, table, root)
    calls = []
    real = versions.partition_spec

    def some(row, keys):
        calls.append(row)
        if len(calls) > 2:
            raise KeyboardInterrupt
        return real(row, keys)

    with monkeypatch.context() as patch:
        patch.setattr(versions, "partition_spec", some)
        with pytest.raises(KeyboardInterrupt):
            upsert_versioned(clean(spark, daily("AB", ["2024-01-01", "2024-01-02"], "5", "2024-06-01")), SPEC, table, root)
    upsert_versioned(clean(spark, INCOMING[3:]), SPEC, table, root)
    assert {float(r.spend) for r in spark.table(table).collect()} == {5.0}


def test_the_stored_side_is_pruned_by_the_plan(spark, place):
    table, root = place
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    upsert_versioned(clean(spark, daily(["A", "B", ""], days)), SPEC, table, root)
    incoming = clean(spark, daily(["A", ""], ["2024-01-04", "2024-01-09"]))
    touched = materialize(touched_partitions(incoming, SPEC))
    scan = scan_touched(spark.table(table), touched)
    assert "dynamicpruning" in plan_of(scan).lower()
    assert Counter((r.account_id, r.day) for r in scan.collect()) == Counter({("A", "4"): 1, ("", "4"): 1, ("A", "9"): 1, ("", "9"): 1})
    nothing = scan_touched(spark.table(table), materialize(touched_partitions(clean(spark, daily("A", ["2030-01-01"])), SPEC)))
    assert nothing.isEmpty()


def test_no_directory_is_looked_up(spark, place, monkeypatch):
    monkeypatch.setattr(curated_source, "scan_partitions", None)
    upsert_versioned(clean(spark, STORED), SPEC, *place)
    result = upsert_versioned(clean(spark, INCOMING), SPEC, *place)
    assert result.rows_written == 3


def test_counts_are_exact_after_a_lost_task(spark, place):
    """Observed counts grow with every repetition of a stage; footers of committed files do not."""
    rows = clean(spark, daily("AB", [f"2024-01-{d:02d}" for d in range(1, 15)]))
    result = upsert_versioned(rows.unionByName(rows), SPEC, *place)
    assert result.rows_written == spark.table(place[0]).count() == 28
    assert sum(r[versions.ROWS] for r in result.partitions) == 28 and len(result.partitions) == 28


def tables_match(spark, table, built):
    stored = spark.table(table).drop(ON_DAY)
    assert stored.columns == built.columns
    got = Counter(tuple(r) for r in stored.collect())
    assert got == Counter(tuple(r) for r in built.collect()) and got


def test_marts_follow_the_loads(spark, place):
    table, root = place
    spec = [s for s in REPORTS if s.report_type == "adset"][0]
    marts = f"{root}-marts"
    environments = (f"dev_{table}", f"prd_{table}")
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    loads = [daily("AB", days), daily("A", days[3:5], "7", "2024-06-01"), daily("C", [days[9], "2024-02-01"], "9")]
    opened = {}
    for number, rows in enumerate(loads):
        upsert_versioned(clean(spark, rows, spec), spec, table, root)
        published = refresh_mart(table, root, spec, "mart", marts, environments)
        watched = refresh_monitoring(table, root, spec, "watch", marts, environments[:1])
        for name in published:
            tables_match(spark, name, build_mart(spark.table(table), spec))
        tables_match(spark, watched[0], build_monitoring(spark.table(table), spec))
        opened[number] = {name: set(spark.table(name).inputFiles()) for name in (*published, *watched)}
    # The second load left the files of eight of ten days alone.
    for name in (*published, *watched):
        assert len({f.rsplit("/on_day=", 1)[1].split("/")[0] for f in opened[0][name] & opened[1][name]}) == 8
    before = {name: versions.versions(spark, name, f"{marts}/{name.replace('.', '/')}", [ON_DAY]) for name in published}
    refresh_mart(table, root, spec, "mart", marts, environments)
    assert before == {name: versions.versions(spark, name, f"{marts}/{name.replace('.', '/')}", [ON_DAY]) for name in published}


def test_a_refresh_that_did_not_happen_is_made_up_for(spark, place):
    table, root = place
    marts = f"{root}-marts"
    for number in (1, 2, 3):
        upsert_versioned(clean(spark, daily("A", [f"2024-01-0{number}"], str(number))), SPEC, table, root)
        if number != 2:
            name = refresh_mart(table, root, SPEC, "late", marts, (f"dev_{table}",))[0]
    tables_match(spark, name, build_mart(spark.table(table), SPEC))


def test_refresh_reads_only_touched_days(spark, place, monkeypatch):
    table, root = place
    marts = f"{root}-marts"
    upsert_versioned(clean(spark, daily("AB", [f"2024-01-{d:02d}" for d in range(1, 11)])), SPEC, table, root)
    refresh_mart(table, root, SPEC, "few", marts, (f"dev_{table}",))
    upsert_versioned(clean(spark, daily("A", ["2024-01-04"], "3", "2024-06-01")), SPEC, table, root)
    plans = []
    from reportmill.plans import refresh

    real = refresh.replace_partitions

    def seen(rows, *args):
        plans.append(plan_of(rows))
        return real(rows, *args)

    monkeypatch.setattr(refresh, "replace_partitions", seen)
    refresh_mart(table, root, SPEC, "few", marts, (f"dev_{table}",))
    assert len(plans) == 1 and "dynamicpruning" in plans[0].lower()
    assert "make_date(cast(year" in plans[0] and "ad_name" not in plans[0].split("ReadSchema", 1)[1].split("\n", 1)[0]


def test_family_of_versioned_reports(spark):
    root = work_dir(spark)
    tag = root[-8:]
    specs = [s for s in REPORTS if s.report_type in ("region", "dma")]
    for rows in (STORED, INCOMING):
        for spec in specs:
            raw = raw_rows(spark, rows).withColumns({name: F.lit("b") for name in spec.breakdowns})
            raw.write.mode("append").option("header", True).csv(report_path(f"{root}/raw", "web", spec.report_type))
        runs = run_family(
            spark, "web", f"{root}/raw", f"{root}/curated", f"{root}/marts", specs,
            curated_db=f"cur_{tag}", environments=(f"dev_{tag}", f"prd_{tag}"), run_one=refresh_report,
        )
    by_type = {run.report_type: run for run in runs}
    assert short(spark.table(by_type["dma"].table)) == EXPECTED and by_type["dma"].marts == []
    for name in by_type["region"].marts:
        tables_match(spark, name, build_mart(spark.table(by_type["region"].table), specs[-1]))
    assert os.path.isdir(f"{root}/curated/web/region/versions".removeprefix("file:"))
    assert PARTITIONS[0] in spark.table(by_type["dma"].table).columns
