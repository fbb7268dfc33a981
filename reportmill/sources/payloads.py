"""Nested JSON documents, one per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.functions import column


DELIVERED, ORIGIN = "__delivered", "__origin"


def scan_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: the whole text in ``value``, when it was delivered, and its path."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(
        "value",
        F.col("_metadata.file_modification_time").alias(DELIVERED),
        F.col("_metadata.file_path").alias(ORIGIN),
    )


def checked_payload(text: Column, keys: list[str]) -> Column:
    """``text`` when its top-level keys are exactly ``keys``; any other document fails the run."""
    found = F.array_sort(F.json_object_keys(text))
    complete = found.eqNullSafe(F.array(*[F.lit(key) for key in sorted(keys)]))
    return F.when(complete, text).otherwise(
        F.raise_error(F.lit(f"incomplete payload, expected the keys {sorted(keys)}"))
    )


def parse_payloads(
    documents: DataFrame, schema: str, keys: list[str] | None = None, text: str = "value"
) -> DataFrame:
    """Payload fields as columns; with ``keys``, documents are checked in the same pass.

    The delivery columns of :func:`scan_payloads` are kept.
    """
    value = column(text) if keys is None else checked_payload(column(text), keys)
    kept = [name for name in (DELIVERED, ORIGIN) if name in documents.columns]
    return documents.select(F.from_json(value, schema).alias("payload"), *kept).select("payload.*", *kept)
