"""Curation of one report: raw files to the newest version of every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reportmill.operators.filters import drop_dirty
from reportmill.operators.merge import UpsertResult, upsert
from reportmill.operators.shape import conform
from reportmill.sources import first_file, scan_delimited
from reportmill.spec import ReportSpec


def curate_frame(
    raw: DataFrame,
    spec: ReportSpec,
    target: str,
    table: str | None = None,
) -> UpsertResult:
    """Type, clean and upsert raw rows."""
    clean = drop_dirty(conform(raw, spec), spec)
    return upsert(clean, spec, target, table)


def curate_report(
    spark: SparkSession,
    spec: ReportSpec,
    source: str,
    target: str,
    table: str | None = None,
    **read_options: object,
) -> UpsertResult:
    """Curate all files under ``source`` into the partitioned table at ``target``.

    A source without files, or without its folder, changes nothing.
    """
    if first_file(spark, source) is None:
        return UpsertResult(0, 0, [])
    options = {"multiLine": spec.multi_line, **read_options}
    return curate_frame(scan_delimited(spark, source, **options), spec, target, table)
