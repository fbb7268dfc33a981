"""Casts that turn bad input into null, whatever the ANSI setting of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = r"[\s\p{Cntrl}]*"
WHOLE_FIRST = rf"^{BLANK}[+-]?\d+\.?\d*{BLANK}$"
FRACTION_ONLY = rf"^{BLANK}[+-]?\.\d*{BLANK}$"


def to_integer(value: Column) -> Column:
    """Whole numbers, with the fraction of a decimal text cut off: ``12.7`` gives 12.

    The patterns keep other text away from the cast: a cast to int that fails costs some fifty
    times one that succeeds, which a column full of ``n/a`` or ``23.0`` would pay on every row.
    """
    text = value.cast("string")
    whole = F.substring_index(text, ".", 1).try_cast("int")
    return F.when(text.rlike(WHOLE_FIRST), whole).when(text.rlike(FRACTION_ONLY), F.lit(0))


def typed(value: Column, data_type: str, source: T.DataType | None = None) -> Column:
    """``value`` as ``data_type``; unparsable or out-of-range input is null.

    Text goes through the patterns of :func:`to_integer`; with any other ``source`` type an
    integer is a plain cast, which cuts the fraction and takes numbers that print as ``1.2E7``.
    """
    if data_type == "string":
        return value.cast("string")
    if data_type in ("int", "integer") and isinstance(source, (T.StringType, type(None))):
        return to_integer(value)
    return value.try_cast(data_type)
