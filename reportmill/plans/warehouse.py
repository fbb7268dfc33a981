"""Mapped load of raw files into a warehouse table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.operators.shape import map_columns
from reportmill.sinks.warehouse import load_batch
from reportmill.sources import first_file, scan_delimited


def load_report(
    spark: SparkSession,
    mapping: Iterable[tuple[str, str, str]],
    source: str,
    sink: Callable[[DataFrame], None],
    **read_options: object,
) -> None:
    """Read, rename and cast, then hand the rows to ``sink``. Every run appends again.

    The sink is one of :mod:`reportmill.sinks.warehouse` with its table bound, for example
    ``lambda df: append_jdbc(df, url, "affiliate")``.
    """
    sink(map_columns(scan_delimited(spark, source, **read_options), mapping))


def batch_of_files(spark: SparkSession, source: str) -> str:
    """A name for the set of files under ``source``, from their paths, sizes and times; it changes when they do."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    digest = F.xxhash64("path", "length", "modificationTime")
    found = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(digest).alias("digest")).first()
    return f"{found.n}-{(found.digest or 0) & ((1 << 64) - 1):016x}"


def load_report_once(
    spark: SparkSession,
    mapping: Iterable[tuple[str, str, str]],
    source: str,
    table: str,
    root: str,
    load_id: str | None = None,
    **read_options: object,
) -> int:
    """:func:`load_report` into a catalog table at ``root`` that may be repeated: the same load replaces itself.

    Without a ``load_id``, the same files are the same load. Returns the number of rows loaded.
    """
    if first_file(spark, source) is None:
        return 0
    rows = map_columns(scan_delimited(spark, source, **read_options), mapping)
    return load_batch(rows, table, root, load_id or batch_of_files(spark, source))
