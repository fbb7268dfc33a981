from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reportmill.plans.family import run_family
from reportmill.plans.warehouse import load_report
from reportmill.operators.marts import build_mart, build_monitoring
from reportmill.operators.shape import conform, with_partitions
from reportmill.session import work_dir
from reportmill.sinks.catalog import publish
from reportmill.sinks.warehouse import append_jdbc, append_table
from reportmill.sources import report_path
from reportmill.spec import AFFILIATE_MAPPING, REPORTS
from rows import SPEC, STORED, raw_rows

PLATFORM = "web"


def land(spark, spec, root, rows):
    raw = raw_rows(spark, rows).withColumns({name: F.lit("b") for name in spec.breakdowns})
    raw.write.mode("append").option("header", True).csv(report_path(root, PLATFORM, spec.report_type))


def run(spark, root, specs):
    return run_family(
        spark, PLATFORM, f"{root}/raw", f"{root}/curated", f"{root}/marts", specs,
        curated_db="fam_curated", environments=("fam_dev", "fam_prd"),
    )


def test_family_twice_with_growing_input(spark):
    root = work_dir(spark)
    specs = [spec for spec in REPORTS if spec.report_type in ("region", "dma")]
    for spec in specs:
        land(spark, spec, f"{root}/raw", STORED)
    first = run(spark, root, specs)
    assert [r.curated.rows_written for r in first] == [3, 3]
    newer = {"ad_id": "1", "execution_date": "2024-01-05", "spend": "100"}
    later = {**newer, "date_start": "2024-03-01"}
    for spec in specs:
        land(spark, spec, f"{root}/raw", [newer, later])
    runs = {r.report_type: r for r in run(spark, root, specs)}
    assert runs["dma"].marts == []
    assert runs["region"].marts == ["fam_dev.web_region_report", "fam_prd.web_region_report"]
    for table in runs["region"].marts:
        totals = {(r.region, str(r.date_start)): float(r.spend) for r in spark.table(table).collect()}
        assert totals == {("b", "2024-01-02 00:00:00"): 105.0, ("b", "2024-03-01 00:00:00"): 100.0}
    watched = {(r.account, str(r.day)): (r.row_count, r.null_clicks) for r in spark.table(runs["dma"].monitoring).collect()}
    assert watched == {("A", "2024-01-02"): (2, 2), ("B", "2024-01-02"): (1, 1), ("A", "2024-03-01"): (1, 1)}


def test_monitoring_reads_only_what_it_reports(spark):
    rows = with_partitions(conform(raw_rows(spark, STORED), SPEC), SPEC)
    path = f"{work_dir(spark)}/t"
    rows.write.partitionBy("account", "year", "month", "day").parquet(path)
    plan = build_monitoring(spark.read.parquet(path), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "ad_name" not in plan and plan.count("Exchange") == 1


def test_mart_without_breakdowns_is_per_ad_set(spark):
    mart = build_mart(conform(raw_rows(spark, STORED), SPEC), SPEC)
    assert mart.columns[:3] == ["adset_id", "adset_name", "date_start"]
    assert float(mart.first().spend) == 6.0


def test_publish_computes_once_and_copies(spark):
    root = work_dir(spark)
    df = spark.range(5).withColumn("r", F.rand())
    tables = publish(df, "copied", root, ("pub_dev", "pub_prd"))
    assert sorted(spark.table(tables[0]).collect()) == sorted(spark.table(tables[1]).collect())
    publish(spark.range(2), "copied", root, ("pub_dev", "pub_prd"))
    assert spark.table(tables[1]).count() == 2


def test_mapped_load_appends_again_on_every_run(spark):
    root = work_dir(spark)
    values = {source: "1.5" if kind != "string" else "s" for source, _, kind in AFFILIATE_MAPPING}
    values.update({"Clicks": "12.7", "Orders - Gross": "n/a", "Unmapped": "u"})
    raw = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{n}` string" for n in values))
    raw.write.option("header", True).csv(f"{root}/raw")
    spark.sql("DROP TABLE IF EXISTS affiliate_test")
    for _ in range(2):
        load_report(
            spark, AFFILIATE_MAPPING, f"{root}/raw", lambda df: append_table(df, "affiliate_test", f"{root}/t")
        )
    table = spark.table("affiliate_test")
    assert table.columns == [target for _, target, _ in AFFILIATE_MAPPING]
    assert table.count() == 2
    row = table.first()
    assert (row.clicks, row.orders_gross, str(row.revenue_gross), row.brand) == (12, None, "1.50000", "s")


def test_jdbc_append_hands_over_url_table_and_limits():
    """No database is started here: a recording writer stands in for the connection."""
    calls = {}

    class Writer:
        def mode(self, mode):
            calls["mode"] = mode
            return self

        def options(self, **options):
            calls.update(options)
            return self

        def jdbc(self, url, table, properties):
            calls.update(url=url, table=table, properties=properties)

    class Frame:
        write = Writer()

        def repartition(self, tasks):
            calls.update(tasks=tasks)
            return self

    append_jdbc(Frame(), "jdbc:any", "t", {"user": "u"})
    assert calls == {
        "mode": "append", "tasks": 64, "numPartitions": 64, "batchsize": 10_000,
        "url": "jdbc:any", "table": "t", "properties": {"user": "u"},
    }


def test_bounded_write_keeps_the_tasks_of_the_scan(spark):
    rows = spark.range(0, 1000, 1, 100).repartition(4)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(4)" in plan and "Coalesce" not in plan


def test_failed_publication_leaves_the_last_one(spark):
    root = work_dir(spark)
    tag = root[-6:]
    environments = (f"dev_{tag}", f"prd_{tag}")
    first = spark.range(3).toDF("n")
    tables = publish(first, "kept", root, environments)
    broken = spark.range(3).selectExpr("raise_error('no') AS n").selectExpr("cast(n AS bigint) AS n")
    with pytest.raises(Exception, match="no"):
        publish(broken, "kept", root, environments)
    assert [spark.table(t).count() for t in tables] == [3, 3]
    publish(spark.range(5).toDF("n"), "kept", root, environments)
    publish(spark.range(6).toDF("other"), "kept", root, environments)
    assert [spark.table(t).columns for t in tables] == [["other"], ["other"]]
    assert [spark.table(t).count() for t in tables] == [6, 6]
