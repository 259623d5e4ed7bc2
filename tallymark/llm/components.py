"""Connected components of an edge table, by labels that only sink and paths that halve."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymark.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b); the label is the least node it reaches.

    Each round takes the least label among a node and its neighbours, then the label of that
    label; rounds end when nothing sinks any more. Every round is a written table.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other")
                  .distinct(), "links")
    labels = staged(both.groupBy("node").agg(
        F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("label").alias("near"))
        sunk = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"),
            F.least("label", F.coalesce("near", "label")).alias("low"))
        above = labels.select(F.col("node").alias("low"), F.col("label").alias("above"))
        after = staged(sunk.join(above, "low", "left").select(
            "node", "old", F.least("low", F.coalesce("above", "low")).alias("label")), "labels")
        changed = after.where(F.col("old") != F.col("label")).limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
