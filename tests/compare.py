"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value: object) -> object:
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(row[n]) for n in names) for row in df.select(*[f"`{n}`" for n in names]).collect())


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return [columns[i] for i in order], rows


FAMILIES = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint",
    "string": "text", "varchar": "text", "boolean": "boolean", "double": "double",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "date": "date",
}


def type_family(name: str) -> str:
    name = name.lower()
    return name.replace(" ", "") if name.startswith("decimal") else FAMILIES.get(name, name)
