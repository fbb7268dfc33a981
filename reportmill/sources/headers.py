"""An index of the headers of delimited files, so that folders may mix files with different columns."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.functions import quote
from reportmill.sources.curated import escape_glob
from reportmill.sources.delimited import CSV_OPTIONS, first_file


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``line``, the first line of every file under ``path``; empty files are left out.

    Every split is a task of its own that stops after its first line, so the files are not read through. The settings for
    that belong to a session of this reader alone. The result lives in that session.
    """
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                if batch.column("start")[0].as_py() == 0:
                    yield batch.select(["file", "line"])
                return

    lines = apart.read.option("recursiveFileLookup", True).text(path)
    rows = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("start"))
    return rows.mapInArrow(head, "file string, line string")


def header_groups(spark: SparkSession, path: str, sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by their column names. Paths come to the driver, which lists the files anyway."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in first_lines(spark, path).collect():
        groups[tuple(next(csv.reader([row.line], delimiter=sep)))].append(unquote(row.file))
    return {names: sorted(files) for names, files in sorted(groups.items())}


def scan_by_header(spark: SparkSession, path: str, **options: object) -> DataFrame | None:
    """All files under ``path``, whatever their headers: one scan for each header, matched by column name.

    Columns that a file lacks are null. All columns are strings, as in a plain scan. ``None`` without any file.
    """
    if first_file(spark, path) is None:
        return None
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    frames = []
    for names, files in header_groups(spark, path, str(options.get("sep", CSV_OPTIONS["sep"]))).items():
        schema = ", ".join(f"{quote(name)} string" for name in names)
        frames.append(reader.schema(schema).csv([escape_glob(file) for file in files]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None
