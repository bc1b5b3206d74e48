"""Connected components of a link table by minimum label, on Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_in_table


def components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """``links(a, b)`` of longs -> ``(node, label)``: the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label
    of that label (pointer jumping), so that long chains shorten by half.
    Everything stays in tables of the shared folder; the driver sees one count
    a round.  Joins read plain tables, so a hub is split by the skew join.
    Nodes without a link are not returned.  An empty table gives an empty one.
    """
    edges = kept_in_table(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "edges")
    labels = kept_in_table(edges.groupBy(F.col("a").alias("node"))
                           .agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    for _ in range(rounds):
        near = (edges.join(labels, edges.b == labels.node)
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        own = labels.alias("l").join(near.alias("n"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("up"))
        hop = labels.select(F.col("node").alias("up"), F.col("label").alias("top"))
        new = kept_in_table(own.join(hop, "up", "left").select(
            "node", "old", F.least("up", F.coalesce("top", "up")).alias("label")), "labels")
        if not new.where("label <> old").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
