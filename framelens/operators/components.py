"""Connected components of an edge table, by rounds of neighbour minima with the lineage cut after each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached. ``nodes`` has node, ``edges`` a and b.

    Each round takes the least label of a node and its neighbours and then follows the label's own label, which halves
    long chains; minima combine before the shuffle.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = written(nodes.select("node", F.col("node").alias("component")))
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("_c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("_c").alias("_c"))
        least = labels.join(heard, "node", "left").select("node", F.least("component", F.coalesce("_c", "component")).alias("component"), F.col("component").alias("_before"))
        jumped = least.join(labels.select(F.col("node").alias("component"), F.col("component").alias("_far")), "component", "left").select("node", F.least("component", F.coalesce("_far", "component")).alias("component"), "_before")
        after = written(jumped)
        labels = after.select("node", "component")
        if not after.where("component <> _before").limit(1).count():
            return labels
