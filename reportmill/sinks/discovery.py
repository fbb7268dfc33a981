"""Bring a catalog table up to date with what others wrote below its folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from reportmill.functions import literal
from reportmill.sinks.catalog import check_location, column_list, table_name


def discover(spark: SparkSession, table: str, path: str, keys: Sequence[str], since: str | None = None) -> list[str]:
    """Register partitions and columns that were written to ``path`` without the catalog; returns the new columns.

    Partitions whose folders are gone leave the table. Columns come from the footers of the Parquet files, which Spark's
    tasks read and merge, of all files or of those modified after ``since`` (a timestamp in the session's time zone). A
    new column is null in older files, and columns differ by more than the case of their names. A column whose type
    contradicts the table or another file fails the call, and the table stays as it was. A folder without new files
    changes no column; one that is not there is an error, so that an outage does not empty the table.
    """
    check_location(spark, table, path)
    fields = {field.name.lower(): field for field in spark.table(table).schema.fields}
    fresh = []
    for field in file_schema(spark, path, since).fields:
        known = fields.get(field.name.lower())
        if field.name.lower() in {key.lower() for key in keys}:
            continue
        if known is None:
            fresh.append(field)
        elif known.dataType.simpleString() != field.dataType.simpleString():
            raise ValueError(f"{field.name} is {field.dataType.simpleString()} in files of {path}, {known.dataType.simpleString()} in {table}")
    name = table_name(*table.split("."))
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({column_list(T.StructType(fresh))})")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return [field.name for field in fresh]


def file_schema(spark: SparkSession, path: str, since: str | None) -> T.StructType:
    """The merged schema of the Parquet files at ``path``, without columns where there are none."""
    reader = spark.read.option("mergeSchema", True)
    if since is not None:
        spark.sql(f"SELECT TIMESTAMP {literal(since)}")  # a wrong text is told apart from an empty folder
        reader = reader.option("modifiedAfter", since).option("timeZone", spark.conf.get("spark.sql.session.timeZone"))
    try:
        return reader.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return T.StructType()
        raise
