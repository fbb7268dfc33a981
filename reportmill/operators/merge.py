"""Union by name, touched partitions, and the partition-scoped upsert."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from reportmill.operators.dedup import keep_latest
from reportmill.operators.shape import project, with_partitions
from reportmill.session import path_exists
from reportmill.sinks.catalog import check_location, register_table
from reportmill.sinks.partitioned import write_partitions
from reportmill.sources.curated import scan_curated, scan_partitions
from reportmill.spec import PARTITIONS, ReportSpec

ORIGIN = "__is_incoming"


@dataclass(frozen=True)
class UpsertResult:
    """Row counts for the log, and the partitions written.

    The counts are observed while the data is written; after a retry of a stage they may be too
    high. Count the stored partitions where exact numbers matter.
    """

    rows_read: int
    rows_written: int
    partitions: list[Row]


def union_by_name(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """All rows of both sides, duplicates included, columns matched by name."""
    return project(left, names).unionByName(project(right, names))


def touched_partitions(rows: DataFrame, spec: ReportSpec) -> DataFrame:
    """The distinct partitions that ``rows`` fall into; a blank account reads back as null."""
    parts = with_partitions(project(rows, [spec.account, spec.date]), spec)
    account = F.nullif(F.col("account"), F.lit("")).alias("account")
    return parts.select(
        account, *[F.col(name).cast("string").alias(name) for name in PARTITIONS[1:]]
    ).distinct()


def list_partitions(touched: DataFrame) -> list[Row]:
    """The touched partitions on the driver, which handles each of their directories anyway."""
    return touched.collect()


def merge_versions(incoming: DataFrame, stored: DataFrame, spec: ReportSpec) -> DataFrame:
    """Newest version per key over both sides; on equal versions the incoming row wins.

    Both sides carry final types already, so versions compare as timestamps and not as text.
    """
    both = union_by_name(
        incoming.withColumn(ORIGIN, F.lit(1)),
        stored.withColumn(ORIGIN, F.lit(0)),
        [*spec.columns, ORIGIN],
    )
    return keep_latest(both, spec.key, spec.version, [ORIGIN]).drop(ORIGIN)


def upsert(
    incoming: DataFrame, spec: ReportSpec, target: str, table: str | None = None
) -> UpsertResult:
    """Merge clean, typed rows into the curated table at ``target``.

    Only partitions with incoming rows are read and replaced: their directories are looked up
    one by one, so the tree is never listed, at any number of them. Running it again with the
    same rows changes nothing, so a replayed batch is safe. The input is read a second time for
    its account and date columns, so ``incoming`` must give the same rows each time. A first load,
    without a folder at ``target``, reads the input once: every key leaves a row in its partition,
    so the partitions are read off the rows that were stored.

    With ``table``, the partitions written are added to the catalog table of that name, which
    must lie at ``target``; a new table gets all the partitions that are stored.
    """
    spark = incoming.sparkSession
    if table is not None:
        check_location(spark, table, target)
    first = not path_exists(spark, target)
    partitions = [] if first else list_partitions(touched_partitions(incoming, spec))
    if incoming.isEmpty() if first else not partitions:
        return UpsertResult(0, 0, [])
    read, written = Observation(), Observation()
    merged = project(incoming, spec.columns).observe(read, F.count(F.lit(1)).alias("n"))
    stored = scan_partitions(spark, spec, target, partitions)
    if stored is None:
        merged = keep_latest(merged, spec.key, spec.version)
    else:
        merged = merge_versions(merged, stored, spec)
    merged = merged.observe(written, F.count(F.lit(1)).alias("n"))
    write_partitions(with_partitions(merged, spec), target, PARTITIONS)
    if first:
        partitions = list_partitions(touched_partitions(scan_curated(spark, spec, target), spec))
    if table is not None:
        register_table(spark, table, target, spec.curated_schema, PARTITIONS, partitions)
    return UpsertResult(read.get["n"], written.get["n"], partitions)
