"""Connected components of an edge table, by the smallest id that each node reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.workspace import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); no row for other nodes.

    Every round each node takes the smallest label among its neighbours, and then the label
    of its label, so that chains shrink by half. Both steps are aggregates with a partial
    sum before the shuffle; a node with very many edges is no hot spot. Each round is
    written to the shared folder, which cuts the lineage and outlives lost executors.
    No edges give no rows; self-edges and repeated edges change nothing.
    """
    both = stage(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("component")
        ),
        "labels",
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(
            F.col("a").alias("node"), "component"
        )
        lower = near.union(labels).groupBy("node").agg(F.min("component").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        new = stage(
            lower.join(jump, "component", "left").select(
                "node", F.least("component", F.coalesce("next", "component")).alias("component")
            ),
            "labels",
        )
        moved = new.join(labels.withColumnRenamed("component", "old"), "node").filter(
            "component != old"
        )
        if moved.isEmpty():
            return new
        labels = new
