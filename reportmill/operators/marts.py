"""Data marts and monitoring tables over a curated report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportmill.functions import column
from reportmill.spec import ReportSpec

ADSET_GROUP = ("adset_id", "adset_name")


def build_mart(curated: DataFrame, spec: ReportSpec, by: tuple[str, ...] | None = None) -> DataFrame:
    """Metric totals per breakdown and day; a report without breakdowns is totalled by ad set."""
    group = [*(by or spec.breakdowns or ADSET_GROUP), spec.date]
    totals = [F.sum(column(name)).alias(name) for name in spec.metrics]
    return curated.groupBy(*[column(name) for name in group]).agg(*totals)


def build_monitoring(curated: DataFrame, spec: ReportSpec) -> DataFrame:
    """Row count, newest dates, spend and missing metrics per account and day."""
    missing = [
        F.count_if(column(name).isNull()).alias("null_" + name.replace(".", "_"))
        for name in spec.metrics
    ]
    day = F.make_date(*[F.col(part).cast("int") for part in ("year", "month", "day")])
    return (
        curated.groupBy("account", "year", "month", "day")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max(column(spec.date)).alias("last_date_start"),
            F.max(column(spec.version)).alias("last_execution_date"),
            F.sum("spend").alias("spend"),
            *missing,
        )
        .withColumn("day", day)
        .drop("year", "month")
        .withColumn("report", F.lit(spec.report_type))
    )
