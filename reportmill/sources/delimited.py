"""Raw delimited files: header, all columns strings, folders read recursively."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reportmill.session import hadoop_path

# A quote inside a quoted text is doubled, and a backslash is a character like any other.
# A header that differs from the schema fails the read rather than shifting columns.
CSV_OPTIONS = {
    "header": True,
    "sep": ",",
    "escape": '"',
    "recursiveFileLookup": True,
    "enforceSchema": False,
}


def report_path(root: str, platform: str, report_type: str) -> str:
    return f"{root.rstrip('/')}/{platform}/{report_type}/"


def scan_delimited(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: object
) -> DataFrame:
    """All files under ``path``. Without a schema, the header of one file gives the names.

    Values with line breaks need ``multiLine=True``, with which a file is read by a single task.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    return (reader.schema(schema) if schema else reader).csv(path)


def first_file(spark: SparkSession, path: str) -> str | None:
    """One data file under ``path``, or ``None`` if there is none (or no such folder)."""
    location, files = hadoop_path(spark, path)
    if not files.exists(location):
        return None
    root, found = files.makeQualified(location).toString(), files.listFiles(location, True)
    while found.hasNext():
        status = found.next()
        inside = status.getPath().toString().removeprefix(root)
        if status.getLen() and not any(is_hidden(part) for part in inside.split("/")):
            return status.getPath().toString()
    return None


def is_hidden(name: str) -> bool:
    """What a scan leaves out, files as well as folders with all that they hold."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def scan_delimited_groups(
    spark: SparkSession, paths: Iterable[str], **options: object
) -> DataFrame:
    """Folders with different headers, matched by column name; absent columns are null."""
    frames = [scan_delimited(spark, path, **options) for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stream_delimited(
    spark: SparkSession, path: str, schema: T.StructType, **options: object
) -> DataFrame:
    """The same files as a stream, for reading only those not seen before."""
    return spark.readStream.options(**{**CSV_OPTIONS, **options}).schema(schema).csv(path)
