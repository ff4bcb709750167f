"""Connected components of an edge table, kept distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import discard, written


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) for every node of
    ``edges`` (columns a, b), as a written table.

    Each round takes the smallest label among the neighbours and then the
    label of that label (pointer jumping), so long chains shrink by half at
    least.  Labels are written every round; edges and labels meet in
    sort-merge joins, whose hot nodes Spark splits.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.select("node", "label").hint("merge"), F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        moved = written(labels.select("node", "label").join(near.hint("merge"), F.col("node") == F.col("a"))
                        .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        up = moved.select(F.col("node").alias("up"), F.col("label").alias("top"))
        jumped = written(moved.join(up.hint("merge"), moved["label"] == up["up"])
                         .select("node", "old", F.least("label", "top").alias("label")), "labels")
        changed = jumped.where("old <> label").limit(1).count()
        discard(labels, moved)
        labels = jumped
        if not changed:
            discard(both)
            return labels
