"""Spend per day and medium, and its combination into one summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.functions import column

OTHER_KEY = "__other_key"


def daily_spend(df: DataFrame, day: Column, medium: str, amount: Column) -> DataFrame:
    """Spend per day and medium. Sums start in the map tasks, so a hot medium shuffles little."""
    return df.groupBy(day.alias("day"), column(medium).alias("medium")).agg(
        F.sum(amount).alias("spend")
    )


def outer_join_on(
    left: DataFrame, right: DataFrame, key: str, hot_keys: bool = False
) -> DataFrame:
    """Full outer join on one key kept as one column; null keys match each other.

    Spark cannot split a hot key of a full outer join over several tasks. With ``hot_keys``, the
    matches and the unmatched rows of each side are joined separately, in join types that
    adaptive execution does split, at the price of reading both sides more than once.
    """
    other = right.withColumnRenamed(key, OTHER_KEY)
    same = column(key).eqNullSafe(column(OTHER_KEY))
    if hot_keys:
        left_keys, other_keys = left.select(column(key)).distinct(), other.select(OTHER_KEY).distinct()
        joined = (
            left.join(other, same, "inner")
            .unionByName(left.join(other_keys, same, "left_anti"), allowMissingColumns=True)
            .unionByName(other.join(left_keys, same, "left_anti"), allowMissingColumns=True)
        )
    else:
        joined = left.join(other, same, "full_outer")
    values = [name for name in left.columns + right.columns if name != key]
    return joined.select(
        F.coalesce(column(key), column(OTHER_KEY)).alias(key), *[column(n) for n in values]
    )


def combine_media(frames: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: outer_join_on(a, b, key), frames)
