"""Connected components of a link table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import stored


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for the nodes of ``links`` (src, dst).

    Every round takes the smallest label among the neighbours and then the label of that label, so long chains shorten
    fast. Labels are combined before the shuffle, and each round is stored, so a lost executor repeats one round.
    """
    both = links.select("src", "dst").union(links.select("dst", "src"))
    both = stored(both.where("src <> dst").distinct())
    labels = stored(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("jump"))
        new = stored(lower.join(jump, "lower").select("node", F.col("label").alias("old"), F.least("lower", "jump").alias("label")))
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels
