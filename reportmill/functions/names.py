"""Column identifiers with dots, and object names in the landing zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportmill.functions.dates import date_parts, iso_day


def plain(name: str) -> str:
    return name.strip("`")


def quote(name: str) -> str:
    """``name`` as one SQL identifier, also when it holds dots."""
    return "`" + plain(name).replace("`", "``") + "`"


def literal(value: object) -> str:
    """``value`` as a SQL string literal, or ``NULL``."""
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def column(name: str) -> Column:
    """The top-level column called ``name``."""
    return F.col(quote(name))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def landing_name(source: str, report: str, day: Column) -> Column:
    """``source/report/year=2024/month=01/day=03/2024-01-03.csv`` for a day; null stays null."""
    parts = date_parts(day, padded=True)
    return F.concat(
        F.lit(f"{source}/{report}"),
        *[piece for name, part in parts.items() for piece in (F.lit(f"/{name}="), part)],
        F.lit("/"),
        iso_day(day),
        F.lit(".csv"),
    )
