"""Partitioned Parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from reportmill.sinks.bounded import bounded


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df`` and leave the others alone.

    Rows are brought together by partition so each directory gets few files; the rebalance lets
    adaptive execution split a partition that is too big for one task and merge small ones. The
    overwrite mode is set on the write itself because a static overwrite would wipe the table.
    """
    writer = (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
    )
    with bounded(df):
        writer.parquet(path)
