"""Curation of only the files that arrived since the last run."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reportmill.operators.shape import map_columns
from reportmill.plans.curate import curate_frame
from reportmill.sinks.warehouse import load_batch
from reportmill.sources import first_file, scan_delimited, stream_delimited
from reportmill.spec import ReportSpec


def curate_new_files(
    spark: SparkSession,
    spec: ReportSpec,
    source: str,
    target: str,
    checkpoint: str,
    table: str | None = None,
    schema: T.StructType | None = None,
    **read_options: object,
) -> None:
    """Upsert every file under ``source`` that ``checkpoint`` does not list yet, then stop.

    ``checkpoint`` must be on shared storage. Limit the size of one upsert with
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``; late rows with an older version never win,
    and a batch replayed after a failure gives the same table. Without a ``schema``, the header
    of one file gives the names. A source without files changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        curate_frame(batch, spec, target, table)

    run_on_new_files(spark, source, checkpoint, merge, schema, {"multiLine": spec.multi_line, **read_options})


def load_new_files(
    spark: SparkSession,
    mapping: Iterable[tuple[str, str, str]],
    source: str,
    table: str,
    root: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    **read_options: object,
) -> None:
    """The mapped load of every file that ``checkpoint`` does not list yet into the warehouse table at ``root``.

    Each batch is a load of its own, named after the checkpoint and the batch; a batch replayed after a failure replaces
    its rows. A source without files changes nothing.
    """
    pairs = list(mapping)
    prefix = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(map_columns(batch, pairs), table, root, f"{prefix}-{batch_id:09d}")

    run_on_new_files(spark, source, checkpoint, load, schema, read_options)


def run_on_new_files(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    work: Callable[[DataFrame, int], None],
    schema: T.StructType | None,
    options: dict[str, object],
) -> None:
    file = first_file(spark, source)
    if file is None:
        return
    header = schema or scan_delimited(spark, file, **options).schema
    query = (
        stream_delimited(spark, source, header, **options)
        .writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
