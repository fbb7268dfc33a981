"""The report family: curate, register, monitor and publish every report."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportmill.operators.marts import build_mart, build_monitoring
from reportmill.operators.merge import UpsertResult
from reportmill.plans.curate import curate_report
from reportmill.session import path_exists
from reportmill.sinks.catalog import create_database, publish
from reportmill.sources import report_path
from reportmill.spec import REPORTS, ReportSpec


@dataclass(frozen=True)
class ReportRun:
    """What one report produced; without any data so far there are no tables."""

    report_type: str
    curated: UpsertResult
    table: str | None
    monitoring: str | None
    marts: list[str]
    error: str | None = None


class ReportsFailed(RuntimeError):
    """Some reports of a family failed; ``runs`` has the results of all of them."""

    def __init__(self, runs: list[ReportRun]) -> None:
        failed = [f"{run.report_type}: {run.error}" for run in runs if run.error]
        super().__init__(f"{len(failed)} of {len(runs)} reports failed; " + "; ".join(failed))
        self.runs = runs


LEDGER = "run_id string, report_type string, error string, rows_read bigint, rows_written bigint, table string, monitoring string, marts array<string>, at timestamp"


def record(spark: SparkSession, ledger: str, run_id: str, run: ReportRun) -> None:
    """Add one line to the ledger, in a folder of its own, as reports end side by side."""
    line = (run_id, run.report_type, run.error, run.curated.rows_read, run.curated.rows_written, run.table, run.monitoring, run.marts, dt.datetime.now())
    spark.createDataFrame([line], LEDGER).coalesce(1).write.json(f"{ledger.rstrip('/')}/{uuid.uuid4().hex}")


def finished(spark: SparkSession, ledger: str, run_id: str) -> dict[str, ReportRun]:
    """The reports that have succeeded in this run, as the ledger has them; partitions are not kept there."""
    if not path_exists(spark, ledger):
        return {}
    done = spark.read.schema(LEDGER).option("recursiveFileLookup", True).json(ledger).where((F.col("run_id") == run_id) & F.col("error").isNull())
    return {
        row.report_type: ReportRun(row.report_type, UpsertResult(row.rows_read, row.rows_written, []), row.table, row.monitoring, row.marts)
        for row in done.collect()
    }


def run_report(
    spark: SparkSession,
    spec: ReportSpec,
    platform: str,
    source: str,
    target: str,
    marts_root: str,
    curated_db: str = "curated",
    environments: tuple[str, ...] = ("dev", "prd"),
) -> ReportRun:
    """One report end to end. Marts and monitoring both read the registered table."""
    table = f"{curated_db}.{platform}_{spec.report_type}_report"
    result = curate_report(spark, spec, source, target, table)
    if not spark.catalog.tableExists(table):
        return ReportRun(spec.report_type, result, None, None, [])
    curated = spark.table(table)
    monitoring = publish(
        build_monitoring(curated, spec),
        f"monitoring_{platform}_{spec.report_type}_report",
        marts_root,
        environments[:1],
    )
    marts = []
    if spec.mart:
        model = f"{platform}_{spec.report_type}_report"
        marts = publish(build_mart(curated, spec), model, marts_root, environments)
    return ReportRun(spec.report_type, result, table, monitoring[0], marts)


def run_family(
    spark: SparkSession,
    platform: str,
    source_root: str,
    target_root: str,
    marts_root: str,
    specs: Iterable[ReportSpec] = REPORTS,
    source_of: Callable[[ReportSpec], str] | None = None,
    curated_db: str = "curated",
    environments: tuple[str, ...] = ("dev", "prd"),
    at_once: int = 4,
    run_one: Callable[..., ReportRun] = run_report,
    ledger: str | None = None,
    run_id: str = "",
) -> list[ReportRun]:
    """All reports; they do not depend on each other, so a few are submitted side by side.

    ``run_one`` is :func:`run_report`, or ``refresh_report`` for tables that are kept up to date day by day. A report that
    fails stops none of the others; :class:`ReportsFailed` tells of all of them in the end. With ``ledger``, a folder of
    JSON lines, the same ``run_id`` given again runs only the reports that have not succeeded in it yet.
    """
    if ledger and not run_id:
        raise ValueError("a ledger needs a run_id")
    create_database(spark, curated_db, target_root)
    for environment in environments:
        create_database(spark, environment, marts_root)

    def run(spec: ReportSpec) -> ReportRun:
        source = source_of(spec) if source_of else report_path(source_root, platform, spec.report_type)
        target = report_path(target_root, platform, spec.report_type)
        return run_one(
            spark, spec, platform, source, target, marts_root, curated_db, environments
        )

    done = finished(spark, ledger, run_id) if ledger else {}

    def attempt(spec: ReportSpec) -> ReportRun:
        if spec.report_type in done:
            return done[spec.report_type]
        try:
            result = run(spec)
        except Exception as error:
            message = str(error).strip().split("\n", 1)[0] or type(error).__name__
            result = ReportRun(spec.report_type, UpsertResult(0, 0, []), None, None, [], message)
        if ledger:
            record(spark, ledger, run_id, result)
        return result

    with ThreadPoolExecutor(at_once) as pool:
        runs = list(pool.map(attempt, specs))
    if any(run.error for run in runs):
        raise ReportsFailed(runs)
    return runs
