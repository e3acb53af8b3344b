"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import park


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (a, b): the smallest node reachable.

    Every node takes the smallest label among its neighbours, then the label of its label, so
    long chains shorten by half in each round. A node with very many links is one row for each
    task after the map-side minimum. Links and labels are parked after each round; the driver
    sees one count.
    """
    both = park(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    labels = park(nearest.select("node", F.least("node", "b").alias("component")))
    while True:
        seen = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("seen"))
        )
        lower = labels.join(seen, "node").select("node", "component", F.least("component", "seen").alias("label"))
        over = labels.select(F.col("node").alias("label"), F.col("component").alias("jump"))
        new = park(lower.join(over, "label").select("node", F.least("label", "jump").alias("component"), F.col("component").alias("was")))
        labels = new.select("node", "component")
        if not new.where("component <> was").limit(1).count():
            return labels
