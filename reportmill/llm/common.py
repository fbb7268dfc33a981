"""What several operators share: stored intermediate tables, row keys, and Arrow map functions."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportmill.session import work_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Python and numpy work on at most so many text bytes at a time.
SLICE_BYTES = 4 << 20


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, unless ``PYTHONPATH`` already leads to it."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _shipped or str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="reportmill-"), "reportmill.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for source in package.rglob("*.py"):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, so that a lost executor costs no recomputation."""
    path = f"{work_dir(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


#: A stored table with at most so many rows and bytes is broadcast; a larger one is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def hinted(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``rows``, which are stored, with a broadcast hint if they are few and their values short.

    Rows of numbers only have a fixed width, so their number is enough.
    """
    if rows.limit(limit + 1).count() > limit:
        return rows
    if all(isinstance(f.dataType, T.NumericType) for f in rows.schema):
        return F.broadcast(rows) if limit * 8 * len(rows.schema) <= BROADCAST_BYTES else rows
    size = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(rows) if size <= BROADCAST_BYTES else rows


def row_hash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Tells rows with the same id and different texts apart."""
    return F.xxhash64(docs[id_col], text_of(docs, text_col))


def rows_without(docs: DataFrame, rejected: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``rejected`` (``row_id``, ``row_hash``) does not list."""
    keys = hinted(stored(rejected.select("row_id", "row_hash").distinct()))
    return docs.join(keys, docs[id_col].eqNullSafe(keys["row_id"]) & (row_hash(docs, id_col, text_col) == keys["row_hash"]), "left_anti")


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with at most ``limit`` bytes of text, single rows apart."""
    start = size = 0
    for row, length in enumerate(pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()):
        if size and size + length > limit:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)


def map_slices(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, column: str = "text") -> DataFrame:
    """``make()`` is called once per task; its function turns each slice of rows into rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        work = make()
        for batch in batches:
            for part in slices(batch, column):
                yield work(part)

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def batch_of(**columns: tuple[object, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, kind) for v, kind in columns.values()], names=list(columns)
    )
