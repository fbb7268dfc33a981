from reportmill.functions.casts import to_integer, typed
from reportmill.functions.dates import (
    as_date,
    date_parts,
    iso_day,
    monday_of,
    month_window,
    week_start,
)
from reportmill.functions.names import base_name, column, landing_name, literal, plain, quote

__all__ = [
    "as_date",
    "base_name",
    "column",
    "date_parts",
    "iso_day",
    "landing_name",
    "literal",
    "monday_of",
    "month_window",
    "plain",
    "quote",
    "to_integer",
    "typed",
    "week_start",
]
