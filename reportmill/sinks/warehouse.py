"""Appending loads into warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.sinks.versions import ROWS, create_versioned, replace_partitions

LOAD = "load_id"


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "append",
    max_connections: int = 64,
    batch_rows: int = 10_000,
) -> None:
    """Add rows to a database table, with a bound on the sessions opened at the same time.

    The shuffle in front keeps the bound to the write; the scan and the casts keep their tasks.
    """
    (
        df.repartition(max_connections)
        .write.mode(mode)
        .options(numPartitions=max_connections, batchsize=batch_rows)
        .jdbc(url, table, properties=dict(properties or {}))
    )


def append_table(df: DataFrame, table: str, path: str | None = None, mode: str = "append") -> None:
    """Add rows to a catalog table, created on first use; ``path`` places its files."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def load_batch(df: DataFrame, table: str, root: str, load_id: str) -> int:
    """Make ``df`` the load ``load_id`` of a table, and of no other: running it again replaces it. Returns its rows.

    The table, created on first use, is partitioned by the load, and its partitions are the ledger
    of what was loaded. The rows of a load appear in one step of the catalog.
    """
    rows = df.withColumn(LOAD, F.lit(load_id))
    create_versioned(df.sparkSession, table, root, rows.schema, [LOAD])
    return sum(row[ROWS] for row in replace_partitions(rows, table, root, [LOAD]))


def loads(spark: SparkSession, table: str) -> list[str]:
    """The ledger: the loads that a table holds."""
    if not spark.catalog.tableExists(table):
        return []
    return sorted(row[LOAD] for row in spark.table(table).select(LOAD).distinct().collect())
