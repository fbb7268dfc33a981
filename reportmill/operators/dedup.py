"""Keep the newest version of every key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportmill.functions import column

RANK = "__version_rank"


def sortable(df: DataFrame, name: str) -> Column:
    """The column itself, or its JSON text where Spark cannot order the type."""
    if isinstance(df.schema[name].dataType, T.AtomicType):
        return column(name)
    return F.to_json(F.struct(column(name)))


def keep_latest(
    df: DataFrame, key: Iterable[str], version: str, prefer: Iterable[str] = ()
) -> DataFrame:
    """One row per key, the one with the greatest version; a null version loses.

    Null key parts count as equal. Equal versions are settled by the ``prefer`` columns and then
    by the remaining ones, greatest value first, so the result never depends on row order. The
    ``== 1`` filter lets Spark cut every map task down to one row per key before the shuffle,
    which keeps a hot key small. A hash leads the window keys so that sorting compares numbers
    and looks at the keys, which may be long and alike, only when the hashes are equal.
    """
    key, prefer = list(key), list(prefer)
    rest = [name for name in df.columns if name not in {*key, version, *prefer}]
    newest_first = [
        sortable(df, name).desc_nulls_last() for name in [version, *prefer, *rest]
    ]
    keys = [column(name) for name in key]
    versions = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*newest_first)
    return (
        df.withColumn(RANK, F.row_number().over(versions)).where(F.col(RANK) == 1).drop(RANK)
    )
