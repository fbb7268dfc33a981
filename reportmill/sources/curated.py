"""Reads of the curated Parquet table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from reportmill.session import hadoop_path, path_exists
from reportmill.spec import PARTITIONS, ReportSpec

LOOKUPS = 16
# The name of a blank partition, and the characters that are escaped in directory names.
BLANK = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def scan_curated(spark: SparkSession, spec: ReportSpec, path: str) -> DataFrame | None:
    """The curated table, or ``None`` when nothing was written yet.

    The schema is given, so no footers are read for inference and account ids keep their
    leading zeros.
    """
    if not path_exists(spark, path):
        return None
    return spark.read.schema(spec.curated_schema).parquet(path)


def partition_path(path: str, partition: Row, keys: Sequence[str] = PARTITIONS) -> str:
    """The directory that Spark's writer gives a partition; a blank value has a name of its own."""
    parts = [f"{name}={escape_name(partition[name])}" for name in keys]
    return "/".join([path.rstrip("/"), *parts])


def escape_name(value: str | None) -> str:
    return ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", value) if value else BLANK


def day_of_partition() -> Column:
    return F.make_date(*[F.col(part).cast("int") for part in PARTITIONS[1:]])


def scan_touched(table: DataFrame, touched: DataFrame, by: Column | None = None) -> DataFrame:
    """The rows of a partitioned table whose partition columns occur in ``touched``, a stored table of such keys.

    The range of ``by`` (the partition's day, unless another expression is given) bounds both sides; the partitions
    within it are pruned by the join when the scan starts. So nothing is looked up or listed outside the range, and no
    key comes to the driver.
    """
    value = day_of_partition() if by is None else by
    bounds = touched.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    within = value.between(F.lit(bounds.low), F.lit(bounds.high))
    rows, keys = table.where(within).alias("rows"), touched.where(within).distinct().alias("keys")
    # A blank account is null; the other keys never are, and a plain equality prunes.
    same = [
        F.col(f"rows.{name}").eqNullSafe(F.col(f"keys.{name}")) if name == PARTITIONS[0] else F.col(f"rows.{name}") == F.col(f"keys.{name}")
        for name in touched.columns
    ]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    return rows.join(keys, condition, "left_semi")


def scan_partitions(
    spark: SparkSession, spec: ReportSpec, path: str, partitions: Sequence[Row]
) -> DataFrame | None:
    """The rows of some partitions, whatever their number; ``None`` when none of them is stored.

    Only the directories of these partitions are looked up and listed, not the tree.
    """
    if not partitions or not path_exists(spark, path):
        return None
    paths = [partition_path(path, partition) for partition in partitions]
    _, files = hadoop_path(spark, path)

    def exists(directory: str) -> bool:
        return files.exists(spark._jvm.org.apache.hadoop.fs.Path(directory))

    with ThreadPoolExecutor(LOOKUPS) as pool:
        found = [p for p, there in zip(paths, pool.map(exists, paths), strict=True) if there]
    if not found:
        return None
    # The names of the directories are data, so their special characters are no patterns.
    plain = [escape_glob(p) for p in found]
    return spark.read.schema(spec.curated_schema).option("basePath", path).parquet(*plain)


def escape_glob(path: str) -> str:
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)
