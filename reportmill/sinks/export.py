"""CSV export and the dated landing zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.functions import column, date_parts
from reportmill.session import hadoop_path
from reportmill.sources.curated import partition_path


ARRIVAL = "__arrival"
# Files of rows without a day; a name that begins with an underscore would not be read.
UNDATED = "undated"
# Everything that is written reads back as it was: quotes, blanks at the ends, microseconds; line
# breaks within a value if the reader is told so (``multiLine``).
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def export_sorted(df: DataFrame, path: str, by: str) -> None:
    """CSV with a header, sorted ascending with nulls last.

    The files follow the sort order by name. Adaptive execution merges a small result into one
    file; a large one stays spread over the cluster. Rows are numbered behind the sort column,
    so that a value shared by very many rows is spread over several tasks as well.
    """
    ordered = df.withColumn(ARRIVAL, F.monotonically_increasing_id()).orderBy(
        column(by).asc_nulls_last(), ARRIVAL
    )
    ordered.drop(ARRIVAL).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def name_files(spark: SparkSession, path: str, day: str) -> None:
    """Give the files of a directory their dated object names, ``2024-01-03-00000.csv`` and so on.

    The numbers follow the order of the parts, so a sorted export stays sorted by name.
    """
    location, files = hadoop_path(spark, path)
    parts = sorted(s.getPath().getName() for s in files.listStatus(location) if s.getPath().getName().startswith("part-"))
    place = spark._jvm.org.apache.hadoop.fs.Path
    for number, part in enumerate(parts):
        if not files.rename(place(location, part), place(location, f"{day}-{number:05d}.csv")):
            raise OSError(f"cannot rename {path}/{part}")


def landing_dir(root: str, source: str, report: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{source}/{report}/year={day:%Y}/month={day:%m}/day={day:%d}"


def land_report(df: DataFrame, root: str, source: str, report: str, day: dt.date, by: str) -> str:
    """Export into the directory of ``day``; another run on the same day replaces it."""
    path = landing_dir(root, source, report, day)
    export_sorted(df, path, by)
    name_files(df.sparkSession, path, day.isoformat())
    return path


def land_by_day(df: DataFrame, path: str, name: str) -> None:
    """Every row into the directory of its own day, with two-digit months and days.

    Rows without a day go into the directory for blank values, in files named ``undated``. The days
    are taken from the rows, which are read a second time for that one column; nothing is listed
    but the directories written.
    """
    parts = date_parts(column(name), padded=True)
    days = df.select(*[part.alias(key) for key, part in parts.items()]).distinct().collect()
    (
        df.withColumns(parts)
        .hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .options(**CSV_OPTIONS)
        .csv(path)
    )
    for day in days:
        dated = "-".join(day) if all(day) else UNDATED
        name_files(df.sparkSession, partition_path(path, day, list(parts)), dated)
