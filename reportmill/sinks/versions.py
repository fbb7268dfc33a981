"""Partitions that are replaced by pointing the catalog table at new folders.

A load is written to a folder of its own, ``versions/<name>``, and a marker says that it is complete. Only then are the
partitions of the table pointed at the new folders, each in one step of the catalog. Until the marker is set the table
stays as it was; a load that is interrupted afterwards is finished by the next one. Readers see every partition either
before or after the load. Folders that no partition points at any more are removed later, by :func:`remove_unused`.

A table may be laid out in buckets. Its rows are then hashed by the bucket columns already, so a merge by these columns
shuffles the incoming rows alone.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportmill.functions import column, literal, quote
from reportmill.session import hadoop_path
from reportmill.sinks.bounded import shuffles_dropped
from reportmill.sinks.catalog import ADD_BATCH, check_location, column_list, partition_spec, table_name
from reportmill.sources.curated import partition_path

SWITCHES = 16
ROWS = "__rows"
LOADING = "__load_"


@dataclass(frozen=True)
class Buckets:
    """Every partition is stored in ``number`` files, by a hash of ``keys``, and sorted by them within a file."""

    number: int
    keys: tuple[str, ...]


def create_versioned(
    spark: SparkSession,
    table: str,
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    buckets: Buckets | None = None,
) -> None:
    """An empty table at ``root`` whose partitions are only those that the catalog names.

    A table that exists already keeps its layout, whatever ``buckets`` says.
    """
    check_location(spark, table, root)
    columns = column_list(schema)
    parts = ", ".join(quote(key) for key in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(*table.split('.'))} ({columns}) USING parquet "
        f"PARTITIONED BY ({parts}) {clustered_by(buckets)}LOCATION {literal(root)}"
    )


def clustered_by(buckets: Buckets | None) -> str:
    if buckets is None:
        return ""
    names = ", ".join(quote(key) for key in buckets.keys)
    return f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets.number} BUCKETS "


def table_buckets(spark: SparkSession, table: str) -> Buckets | None:
    """The bucket layout that the catalog has for ``table``."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(*table.split('.'))}")
    found = {row.col_name: row.data_type for row in described.where("col_name IN ('Num Buckets', 'Bucket Columns')").collect()}
    if "Num Buckets" not in found:
        return None
    return Buckets(int(found["Num Buckets"]), tuple(re.findall("`([^`]+)`", found["Bucket Columns"])))


def by_bucket(rows: DataFrame, buckets: Buckets) -> DataFrame:
    """``rows`` with one task for each bucket, hashed as the stored files are."""
    return rows.repartition(buckets.number, *[column(key) for key in buckets.keys])


def replace_partitions(rows: DataFrame, table: str, root: str, keys: Sequence[str], placed: bool = False) -> list[Row]:
    """Replace the partitions that ``rows`` fall into. Returns their keys with the number of rows written to each.

    The numbers are read from the footers of the files that were committed, so they are exact after any retry.
    Rows for a bucketed table are shuffled by bucket, unless they are ``placed`` so already.
    """
    spark = rows.sparkSession
    finish_pending(spark, table, root, keys)
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = version_path(root, name)
    buckets = table_buckets(spark, table)
    with shuffles_dropped(spark):
        if buckets is None:
            rows.hint("rebalance", *keys).write.partitionBy(*keys).parquet(path)
        else:
            write_buckets(rows if placed else by_bucket(rows, buckets), f"{table}{LOADING}{name.replace('-', '_')}", path, keys, buckets)
    mark(spark, root, name)
    written = written_partitions(spark, table, path, keys)
    switch(spark, table, path, keys, written)
    unmark(spark, root, name)
    return written


def write_buckets(rows: DataFrame, loading: str, path: str, keys: Sequence[str], buckets: Buckets) -> None:
    """Write ``rows`` to ``path`` in buckets. Spark writes buckets only to tables, so a table ``loading`` exists meanwhile."""
    writer = rows.write.format("parquet").option("path", path).partitionBy(*keys)
    writer.bucketBy(buckets.number, *buckets.keys).sortBy(*buckets.keys).saveAsTable(table_name(*loading.split(".")))
    # The table is external: its files stay.
    rows.sparkSession.sql(f"DROP TABLE {table_name(*loading.split('.'))}")


def drop_loading(spark: SparkSession, table: str, limit: str) -> None:
    """Drop the tables of loads that died before ``limit`` while they were writing buckets."""
    database, name = ([""] + table.split("."))[-2:]
    within = f"IN {quote(database)} " if database else ""
    listed = spark.sql(f"SHOW TABLES {within}LIKE {literal(f'{name}{LOADING}*'.lower())}").collect()
    pattern = re.compile(re.escape(f"{name}{LOADING}") + r"(\d{20})_[0-9a-f]{8}", re.IGNORECASE)
    for row in listed:
        found = pattern.fullmatch(row.tableName)
        if found and found[1] < limit:
            spark.sql(f"DROP TABLE IF EXISTS {table_name(*[part for part in (database, row.tableName) if part])}")


def version_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/versions/{name}"


def marker(spark: SparkSession, root: str, name: str = ""):
    return hadoop_path(spark, f"{root.rstrip('/')}/pending/{name}".rstrip("/"))


def mark(spark: SparkSession, root: str, name: str) -> None:
    location, files = marker(spark, root, name)
    files.create(location).close()


def unmark(spark: SparkSession, root: str, name: str) -> None:
    location, files = marker(spark, root, name)
    files.delete(location, False)


def pending(spark: SparkSession, root: str) -> list[str]:
    """Complete loads whose partitions may not all be switched yet, oldest first."""
    location, files = marker(spark, root)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def finish_pending(spark: SparkSession, table: str, root: str, keys: Sequence[str]) -> None:
    """Switch what an interrupted load left complete but not switched."""
    for name in pending(spark, root):
        path = version_path(root, name)
        switch(spark, table, path, keys, written_partitions(spark, table, path, keys))
        unmark(spark, root, name)


def versions(spark: SparkSession, table: str, root: str, keys: Sequence[str], since: str | None = None) -> list[str]:
    """The loads of a versioned table after the version ``since``, oldest first; what is left to switch is switched before."""
    location, files = hadoop_path(spark, f"{root.rstrip('/')}/versions")
    if not spark.catalog.tableExists(table) or not files.exists(location):
        return []
    finish_pending(spark, table, root, keys)
    names = sorted(status.getPath().getName() for status in files.listStatus(location))
    return [name for name in names if since is None or name > since]


def changed_keys(spark: SparkSession, table: str, root: str, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The distinct values of ``keys``, some of the partition columns, in the loads ``names``; only directories are read."""
    schema = spark.table(table).schema
    loads = [spark.read.schema(schema).parquet(version_path(root, name)).select(*keys) for name in names]
    return reduce(DataFrame.unionByName, loads).distinct()


def written_partitions(spark: SparkSession, table: str, path: str, keys: Sequence[str]) -> list[Row]:
    """The partitions in a version folder and their row counts. No column is read but the directory names."""
    schema = spark.table(table).schema
    stored = spark.read.schema(schema).parquet(path)
    return stored.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)).collect()


def switch(spark: SparkSession, table: str, path: str, keys: Sequence[str], written: Sequence[Row]) -> None:
    """Point the table at the folders of ``written``: new partitions in batches, the others one by one."""
    name = table_name(*table.split("."))
    placed = [(partition_spec(row, keys), literal(partition_path(path, row, keys))) for row in written]
    for start in range(0, len(placed), ADD_BATCH):
        added = " ".join(f"{spec} LOCATION {place}" for spec, place in placed[start : start + ADD_BATCH])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")

    def point(item: tuple[str, str]) -> None:
        spark.sql(f"ALTER TABLE {name} {item[0]} SET LOCATION {item[1]}")

    with ThreadPoolExecutor(SWITCHES) as pool:
        list(pool.map(point, placed))
    spark.catalog.refreshTable(table)


def remove_unused(spark: SparkSession, table: str, root: str, older_than_hours: float = 24.0) -> int:
    """Remove the folders of loads that started so long ago and that no partition points at; returns their number.

    Which files are in use is compared in Spark; only the directories to remove come to the driver, one by one.
    """
    location, files = hadoop_path(spark, f"{root.rstrip('/')}/versions")
    if not files.exists(location):
        return 0
    limit = f"{time.time_ns() - int(older_than_hours * 3.6e12):020d}"
    drop_loading(spark, table, limit)
    used = spark.table(table).select(F.col("_metadata.file_path").alias("file")).distinct()
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location.toString())
    stored = stored.where("path LIKE '%.parquet'").select("path", F.col("_metadata.file_path").alias("file"))
    version = F.regexp_extract("path", r"/versions/(\d{20}-[0-9a-f]{8})/", 1)
    stale = stored.where((version < limit) & (version != "") & ~version.isin(pending(spark, root)))
    unused = stale.join(used, "file", "left_anti").select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
    removed = 0
    for row in unused.toLocalIterator():
        files.delete(hadoop_path(spark, row.folder)[0], True)
        removed += 1
    return removed
