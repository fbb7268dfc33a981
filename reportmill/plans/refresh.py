"""Marts and monitoring kept up to date load by load, day by day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.functions import column, iso_day, literal
from reportmill.operators.filters import drop_dirty
from reportmill.operators.marts import build_mart, build_monitoring
from reportmill.operators.merge import UpsertResult
from reportmill.operators.shape import conform, project
from reportmill.operators.versioned import upsert_versioned
from reportmill.plans.family import ReportRun
from reportmill.session import materialize
from reportmill.sinks.catalog import ENVIRONMENTS, create_database, table_name
from reportmill.sinks.versions import changed_keys, create_versioned, replace_partitions, versions
from reportmill.sources import first_file, scan_delimited
from reportmill.sources.curated import day_of_partition, scan_touched
from reportmill.spec import PARTITIONS, ReportSpec

ON_DAY = "on_day"
REFRESHED = "reportmill.refreshed"


def refreshed_version(spark: SparkSession, table: str) -> str | None:
    """The last version of its source that a refreshed table holds, or ``None`` for a table that is not there yet."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {table_name(*table.split('.'))}").where(F.col("key") == REFRESHED).first()
    return found["value"] if found else None


def refresh_daily(
    source: str,
    source_root: str,
    keys: Sequence[str],
    build: Callable[[DataFrame], DataFrame],
    table: str,
    root: str,
) -> bool:
    """Bring ``table``, which ``build`` makes from the versioned table ``source``, up to date. False if it is already.

    The groups that ``build`` makes lie within one day each and carry it as ``on_day``. The days in versions of the source
    that ``table`` has not seen are recomputed: only their partitions are read, and only their partitions are replaced.
    The last version seen is noted at the table afterwards, so a refresh that did not happen is made up for by the next.
    """
    spark = SparkSession.active()
    seen = refreshed_version(spark, table)
    new = versions(spark, source, source_root, keys, seen)
    if not new:
        return False
    rows = spark.table(source)
    if seen is not None:
        days = [name for name in keys if name != PARTITIONS[0]]
        touched = materialize(changed_keys(spark, source, source_root, days, new))
        rows = scan_touched(rows, touched, F.col(ON_DAY) if ON_DAY in days else day_of_partition())
    built = build(rows)
    built = project(built, [*[name for name in built.columns if name != ON_DAY], ON_DAY])
    create_versioned(spark, table, root, built.schema, [ON_DAY])
    replace_partitions(built, table, root, [ON_DAY])
    note = f"{literal(REFRESHED)} = {literal(new[-1])}"
    spark.sql(f"ALTER TABLE {table_name(*table.split('.'))} SET TBLPROPERTIES ({note})")
    return True


def refresh_environments(
    curated: str,
    curated_root: str,
    build: Callable[[DataFrame], DataFrame],
    day: Column,
    model: str,
    root: str,
    environments: Sequence[str] = ENVIRONMENTS,
) -> list[str]:
    """:func:`refresh_daily` for the first environment; each further one takes over the days that are new in the one before."""
    spark = SparkSession.active()
    source, source_root, keys = curated, curated_root, PARTITIONS
    published: list[str] = []
    for environment in environments:
        create_database(spark, environment, root)
        table, path = f"{environment}.{model}", f"{root.rstrip('/')}/{environment}/{model}"
        make = (lambda rows: rows) if published else (lambda rows: build(rows).withColumn(ON_DAY, iso_day(day)))
        refresh_daily(source, source_root, keys, make, table, path)
        source, source_root, keys = table, path, (ON_DAY,)
        published.append(table)
    return published


def refresh_mart(
    curated: str, curated_root: str, spec: ReportSpec, model: str, root: str, environments: Sequence[str] = ENVIRONMENTS
) -> list[str]:
    """The mart of :func:`build_mart` over a versioned table, with the further column ``on_day``."""
    return refresh_environments(
        curated, curated_root, lambda rows: build_mart(rows, spec), column(spec.date), model, root, environments
    )


def refresh_monitoring(
    curated: str, curated_root: str, spec: ReportSpec, model: str, root: str, environments: Sequence[str] = ENVIRONMENTS[:1]
) -> list[str]:
    """The monitoring table of :func:`build_monitoring` over a versioned table, with the further column ``on_day``."""
    return refresh_environments(
        curated, curated_root, lambda rows: build_monitoring(rows, spec), F.col("day"), model, root, environments
    )


def refresh_report(
    spark: SparkSession,
    spec: ReportSpec,
    platform: str,
    source: str,
    target: str,
    marts_root: str,
    curated_db: str = "curated",
    environments: tuple[str, ...] = ENVIRONMENTS,
) -> ReportRun:
    """One report end to end, with work in proportion to the days that its files touch.

    It can take the place of :func:`reportmill.plans.family.run_report` for a family whose tables are all versioned.
    """
    model = f"{platform}_{spec.report_type}_report"
    table, result = f"{curated_db}.{model}", UpsertResult(0, 0, [])
    if first_file(spark, source) is not None:
        raw = scan_delimited(spark, source, multiLine=spec.multi_line)
        result = upsert_versioned(drop_dirty(conform(raw, spec), spec), spec, table, target)
    if not spark.catalog.tableExists(table):
        return ReportRun(spec.report_type, result, None, None, [])
    monitoring = refresh_monitoring(table, target, spec, f"monitoring_{model}", marts_root, environments[:1])
    marts = refresh_mart(table, target, spec, model, marts_root, environments) if spec.mart else []
    return ReportRun(spec.report_type, result, table, monitoring[0], marts)
