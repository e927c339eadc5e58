"""Connected components by minimum-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialise


def connected(links: DataFrame) -> DataFrame:
    """Rows ``(node, component)`` for every node of ``links(a, b)``; component is its smallest reachable node. ``links`` is read more than once.

    Each round takes the least label among a node's neighbours (combined before the shuffle, so a
    node with very many links costs one row a task) and then the label of that label, so paths
    halve. Every round is written to the shared folder, and the one before it removed; nothing but a flag reaches the driver.
    """
    rows = 2 * links.count()
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.where("a <> b").distinct(), "edges", rows)
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels", rows)
    before = labels
    while True:
        best = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        stepped = labels.join(best, "node", "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        new = materialise(stepped.join(jump, "component", "left").select("node", "old", F.least("component", "far").alias("component")), "labels", rows)
        discard(before)
        before, labels = new, new.select("node", "component")
        if new.where("component < old").isEmpty():
            discard(edges)
            return labels
