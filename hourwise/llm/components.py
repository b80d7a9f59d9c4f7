"""Connected components of an edge table by contraction, in joins only."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _roots(forest: DataFrame) -> DataFrame:
    """(node, label) of a forest in which each node points to a smaller one: label is the tree's root. A node's label becomes its
    label's label until none moves; a round has one row a node."""
    labels = forest
    while True:
        up = labels.select(F.col("node").alias("at"), F.col("label").alias("far"))
        moved = materialize(labels.join(up, F.col("label") == F.col("at"), "left")
                            .select("node", F.coalesce("far", "label").alias("label"), F.col("far").isNotNull().alias("moved")), "roots")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b): label is the smallest node of the component.
    Each round keeps one edge a node, to its smallest neighbour below it, collapses those trees to their roots, and goes on with the
    edges between different trees alone. Every round is written to the shared folder."""
    left = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("label", F.col("node"))
    left = left.where("a != b")
    while True:
        roots = _roots(materialize(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "forest"))
        to = roots.select(F.col("node").alias("at"), F.col("label").alias("root"))
        labels = materialize(labels.join(to, F.col("label") == F.col("at"), "left")
                             .select("node", F.coalesce("root", "label").alias("label")), "labels")
        for end, other in (("a", "b"), ("b", "a")):
            left = left.join(to, F.col(end) == F.col("at"), "left").select(F.coalesce("root", end).alias(end), other)
        left = materialize(left.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if left.isEmpty():
            return labels
