"""The upsert into a catalog table whose partitions are switched, not overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reportmill.operators.dedup import keep_latest
from reportmill.operators.merge import UpsertResult, merge_versions, touched_partitions
from reportmill.operators.shape import project, with_partitions
from reportmill.session import materialize
from reportmill.sinks.versions import (
    ROWS,
    Buckets,
    by_bucket,
    create_versioned,
    finish_pending,
    replace_partitions,
    table_buckets,
)
from reportmill.sources.curated import scan_touched
from reportmill.spec import PARTITIONS, ReportSpec


def upsert_versioned(
    incoming: DataFrame, spec: ReportSpec, table: str, root: str, buckets: int | None = None
) -> UpsertResult:
    """Merge clean, typed rows into ``table``, which lies at ``root`` and is the only way to its rows.

    The stored side is a scan of the table, pruned to the touched partitions by the plan itself. The merge is written to
    new folders and the partitions are pointed there afterwards, so a load that dies leaves the table whole, and running
    it again gives the same table. ``rows_written`` is read from the footers of the files and exact after any retry.
    The input is read a second time for its account and date columns.

    With ``buckets``, a new table is laid out in that many buckets by the key. Later loads find the layout in the
    catalog: the incoming rows are cut down to one for each key and shuffled to the buckets, and the stored rows, which
    lie there already, are neither shuffled for the merge nor for the write. A bucket of all touched partitions is one
    task, and each partition has a file for each bucket, so choose the number by the bytes that a load touches.
    """
    spark = incoming.sparkSession
    layout = Buckets(buckets, spec.key) if buckets else None
    create_versioned(spark, table, root, spec.curated_schema, PARTITIONS, layout)
    finish_pending(spark, table, root, PARTITIONS)
    touched = materialize(touched_partitions(incoming, spec))
    if touched.isEmpty():
        return UpsertResult(0, 0, [])
    read = Observation()
    rows = project(incoming, spec.columns).observe(read, F.count(F.lit(1)).alias("n"))
    layout = table_buckets(spark, table)
    if layout:
        # A key may hold a third of the rows, so there is one row for each before they go to the buckets.
        rows = by_bucket(keep_latest(rows, spec.key, spec.version), layout)
    merged = merge_versions(rows, scan_touched(spark.table(table), touched), spec)
    written = replace_partitions(with_partitions(merged, spec), table, root, PARTITIONS, placed=layout is not None)
    return UpsertResult(read.get["n"], sum(row[ROWS] for row in written), written)
