"""Catalog tables over curated data, and publication of marts."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from reportmill.functions import literal, quote
from reportmill.session import hadoop_path

ENVIRONMENTS = ("dev", "prd")
ADD_BATCH = 500


def table_name(*parts: str) -> str:
    return ".".join(quote(part) for part in parts)


def create_database(spark: SparkSession, name: str, root: str) -> None:
    """A database whose own folder lies on the same storage as its tables."""
    location = literal(f"{root.rstrip('/')}/{name}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)} LOCATION {location}")


def check_location(spark: SparkSession, table: str, path: str) -> None:
    """A table that exists already must lie at ``path``."""
    location = table_location(spark, table)
    if location is None:
        return
    there, here = (qualified(spark, p) for p in (location, path))
    if there != here:
        raise ValueError(f"table {table} lies at {there}, not at {here}")


def table_location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(*table.split('.'))}")
    found = described.where("col_name = 'Location'").first()
    return found["data_type"] if found else None


def qualified(spark: SparkSession, path: str) -> str:
    location, files = hadoop_path(spark, path)
    return files.makeQualified(location).toString().rstrip("/")


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    partitions: Sequence[str],
    added: Sequence[Row] | None = None,
) -> None:
    """Make the Parquet directory at ``path`` a catalog table with all its partitions.

    With ``added``, only those partitions are registered in a table that exists already, which
    saves listing the whole directory tree after every small load.
    """
    name = table_name(*table.split("."))
    if added is None or not spark.catalog.tableExists(table):
        columns = column_list(schema)
        keys = ", ".join(quote(key) for key in partitions)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({keys}) LOCATION {literal(path)}"
        )
        spark.sql(f"MSCK REPAIR TABLE {name}")
    for start in range(0, len(added or ()), ADD_BATCH):
        specs = [partition_spec(row, partitions) for row in added[start : start + ADD_BATCH]]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")
    spark.catalog.refreshTable(table)


def partition_spec(row: Row, partitions: Sequence[str]) -> str:
    values = {key: row[key] for key in partitions}
    return "PARTITION ({})".format(
        ", ".join(f"{quote(key)} = {literal(value)}" for key, value in values.items())
    )


def publish(
    df: DataFrame, model: str, root: str, environments: Sequence[str] = ENVIRONMENTS
) -> list[str]:
    """Write a mart to the first environment and copy it on to the next ones.

    The mart is computed once: later environments read what was published just before. Every
    publication is a table of its own, and ``model`` a view that is pointed to it in one step of
    the catalog, so a write that fails leaves the last publication in place and the name is never
    missing. The publication before the last one is kept for those who are still reading it.
    """
    spark = df.sparkSession
    published: list[str] = []
    for environment in environments:
        create_database(spark, environment, root)
        view = f"{environment}.{model}"
        rows = spark.table(published[-1]) if published else df
        version = f"{model}__{time.time_ns():020d}{uuid.uuid4().hex[:8]}"
        path = f"{root.rstrip('/')}/{environment}/{model}"
        rows.write.parquet(f"{path}/{version}")
        table, columns = table_name(environment, version), column_list(rows.schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION {literal(f'{path}/{version}')}")
        point_view(spark, view, f"SELECT * FROM {table}")
        drop_versions(spark, environment, model, path)
        published.append(view)
    return published


def column_list(schema: T.StructType) -> str:
    return ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def point_view(spark: SparkSession, view: str, query: str) -> None:
    """Make ``view`` show ``query``. An existing view is altered, not dropped and made again."""
    name = table_name(*view.split("."))
    exists = spark.catalog.tableExists(view)
    if exists and table_location(spark, view) is not None:
        # A table of that name comes from a time before publications were views.
        spark.sql(f"DROP TABLE {name}")
        exists = False
    spark.sql(f"ALTER VIEW {name} AS {query}" if exists else f"CREATE VIEW {name} AS {query}")


def drop_versions(spark: SparkSession, environment: str, model: str, path: str, keep: int = 2) -> None:
    """Remove all publications of ``model`` but the newest ones, tables and files."""
    listed = spark.sql(f"SHOW TABLES IN {quote(environment)} LIKE {literal(model.lower() + '__*')}").collect()
    pattern = re.compile(re.escape(model) + r"__[0-9a-f]{28}", re.IGNORECASE)
    names = sorted(row.tableName for row in listed if pattern.fullmatch(row.tableName))
    for name in names[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(environment, name)}")
        location, files = hadoop_path(spark, f"{path}/{model}{name[len(model):]}")
        files.delete(location, True)
