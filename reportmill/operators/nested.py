"""Nested payload fields to flat rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.functions import column


def last_entries(field: Column) -> Column:
    """The entries of a map, of a key that is repeated in the payload only the last one."""
    keys = F.map_keys(field)
    last = lambda entry, i: F.size(keys) - F.array_position(F.reverse(keys), entry["key"]) == i
    return F.filter(F.map_entries(field), last)


def flatten_map(
    df: DataFrame,
    field: str,
    value_field: str,
    key_label: str,
    value_label: str,
    carry: Iterable[str] = (),
) -> DataFrame:
    """One row per entry of a map of structs: the key, one field, and the ``carry`` columns."""
    kept = [column(name) for name in carry]
    entries = df.select(F.explode(last_entries(column(field))).alias("entry"), *kept)
    return entries.select(
        F.col("entry.key").alias(key_label),
        F.col("entry.value").getField(value_field).alias(value_label),
        *kept,
    )


def flatten_array(
    df: DataFrame, field: str, labels: dict[str, str], carry: Iterable[str] = (), position: str | None = None
) -> DataFrame:
    """One row per element of an array of structs: the labelled fields and the ``carry`` columns.

    ``position`` names a column for the place of the element in its array.
    """
    kept = [column(name) for name in carry]
    elements = df.select(F.posexplode(column(field)).alias("place", "element"), *kept)
    return elements.select(
        *[F.col("element").getField(name).alias(label) for name, label in labels.items()],
        *kept,
        *([F.col("place").alias(position)] if position else []),
    )
