"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of each component, for nodes with a link.

    Each round takes the smallest label of all neighbours and then the label of that
    label (pointer jumping), and ends when nothing changes.  Every round writes its
    labels to the shared checkpoint folder."""
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = cut_lineage(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut_lineage(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                         .select("node", F.least("node", "m").alias("label")))
    while True:
        near = edges.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("label").alias("m"))
        low = labels.join(near, F.col("node") == F.col("u")).select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("low"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        new = cut_lineage(low.join(jump, F.col("low") == F.col("at"), "left").select(
            "node", "old", F.least("low", "next").alias("label")))
        moved = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels.select("node", F.col("label").alias("component"))
