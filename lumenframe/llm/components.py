"""Connected components by repeated contraction; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, written


def _roots(parent: DataFrame, scratch: list[str]) -> DataFrame:
    """(v, root) for a forest (v, parent) in which parents are smaller: pointers are doubled until they rest."""
    while True:
        step = written(
            parent.alias("a")
            .join(parent.alias("b"), F.col("a.parent") == F.col("b.v"), "left")
            .select(F.col("a.v").alias("v"), F.coalesce("b.parent", "a.parent").alias("parent"), F.col("b.parent").isNotNull().alias("moved")),
            "roots",
            scratch,
        )
        if not step.filter("moved").head(1):
            return step.select("v", F.col("parent").alias("root"))
        parent = step.select("v", "parent")


def components(edges: DataFrame) -> DataFrame:
    """(v, component) for every node of the edges (a, b), both long and in any direction; the id is the least node.

    Self-loops and repeated edges do no harm; nodes without an edge to another node do not appear. Each round takes
    the least neighbour as parent, contracts the trees and keeps the edges between different trees.
    """
    spark, scratch, labels = edges.sparkSession, [], []
    edges = written(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", scratch)
    label = None
    while edges.head(1):
        parent = edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("parent"))
        root = _roots(parent, scratch)
        if label is None:
            label = edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("root", F.col("v"))
        label = label.join(root.select(F.col("v").alias("root"), F.col("root").alias("_up")), "root", "left").select(
            "v", F.coalesce("_up", "root").alias("root")
        )
        label = written(label, "labels", labels)
        up = root.select("v", "root")
        edges = written(
            edges.join(up.select(F.col("v").alias("a"), F.col("root").alias("ra")), "a", "left")
            .join(up.select(F.col("v").alias("b"), F.col("root").alias("rb")), "b", "left")
            .select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
            .filter("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
            scratch,
        )
    if label is None:  # its one table stays, as the empty result reads it
        return edges.select(F.col("a").alias("v"), F.col("b").alias("component")).limit(0)
    discard(spark, scratch + labels[:-1])
    return label.select("v", F.col("root").alias("component"))
