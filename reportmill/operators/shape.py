"""Column-wise operators: constants, copies, projection, renames, casts and mappings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.functions import column, date_parts, plain, quote, typed
from reportmill.spec import PARTITIONS, ReportSpec


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def with_copies(df: DataFrame, **sources: str) -> DataFrame:
    """New columns that repeat existing ones: ``with_copies(df, account="account_id")``."""
    return df.withColumns({name: column(source) for name, source in sources.items()})


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns in the given order; back-ticks around a name are dropped."""
    return df.selectExpr(*[quote(name) for name in names])


def rename_all(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renames applied one after the other; names that do not occur are left out."""
    return df.withColumnsRenamed(dict(names))


def typed_column(df: DataFrame, name: str, kind: str) -> Column:
    return typed(column(name), kind, df.schema[plain(name)].dataType)


def cast_all(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: typed_column(df, name, kind) for name, kind in types.items()})


def map_columns(df: DataFrame, mapping: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rename and cast by (source, target, type); columns without an entry are dropped."""
    return df.select(
        *[typed_column(df, source, kind).alias(target) for source, target, kind in mapping]
    )


def conform(raw: DataFrame, spec: ReportSpec) -> DataFrame:
    """Report columns only, in their fixed order and with their final types."""
    return raw.select(
        *[typed_column(raw, name, spec.types.get(name, "string")).alias(name) for name in spec.columns]
    )


def with_partitions(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """Adds the partition columns, derived from the account and date of each row."""
    values = {"account": column(spec.account), **date_parts(column(spec.date))}
    return df.withColumns({name: values[name] for name in PARTITIONS})
