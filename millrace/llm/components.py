"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the edges ``a, b``; the nodes of a component share
    a label. No edges, no rows.

    Every round sends each node to its smallest neighbour, that neighbour's, and so on, and
    puts the labels in place of the nodes of the edges, until no edge is left. A path of n
    nodes takes about log n rounds. Nothing is gathered per node but a minimum.
    """
    left = settle(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    while labels is None or not left.isEmpty():
        near = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("b"))
        step = settle(near.select(F.col("a").alias("node"), F.least("a", "b").alias("label")))
        for _ in range(2):
            step = _then(step, step)
        step = settle(step)
        labels = step if labels is None else settle(_then(labels, step))
        for end in ("a", "b"):
            left = left.join(step, F.col(end) == F.col("node"), "left").withColumn(end, F.coalesce("label", end)).select("a", "b")
        left = settle(left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels


def _then(labels: DataFrame, step: DataFrame) -> DataFrame:
    after = step.select(F.col("node").alias("_from"), F.col("label").alias("_to"))
    return labels.join(after, F.col("label") == F.col("_from"), "left").select("node", F.coalesce("_to", "label").alias("label"))
