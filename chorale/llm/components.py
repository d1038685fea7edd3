"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it reaches) of every node of the links (a, b).

    Every round a node takes the smallest label among its neighbours and itself, then its
    label's label. Labels are written to the checkpoint folder between rounds.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).where("node <> other")
    edges = kept(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = kept(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(
            F.min("label").alias("near")
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = kept(
            lower.join(jump, "next").select("node", "label", F.least("next", "far").alias("next"))
        )
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.where("label <> next").isEmpty():
            return labels
