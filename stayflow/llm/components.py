"""Connected components by label propagation with pointer jumping, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard


def components(links: DataFrame) -> DataFrame:
    """id and label (the smallest id reachable) of every id in ``links`` (columns a, b; longs, each link once or more).

    Each round gives every component the smallest label next to it, then has labels point at the label of their label;
    the links are contracted to labels and shrink, so long chains take few rounds. Only counts reach the driver.
    """
    edges = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = cut(ids.select("id", F.col("id").alias("label")), "cc-labels")
    while not edges.isEmpty():
        # every node's smallest neighbour (or itself), then the end of the chain of smallest neighbours
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")), "cc-parents")
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
            jumped = cut(parent.select("a", "p").join(up, "p", "left").select("a", F.coalesce("q", "p").alias("p"), (F.coalesce("q", "p") != F.col("p")).alias("moved")), "cc-parents")
            discard(parent)
            parent = jumped
            if jumped.where("moved").isEmpty():
                break
        root = parent.select(F.col("a").alias("label"), F.col("p").alias("root"))
        before = labels, edges, parent
        labels = cut(labels.join(root, "label", "left").select("id", F.coalesce("root", "label").alias("label")), "cc-labels")
        l, r = (parent.select(F.col("a").alias(side), F.col("p").alias(f"p{side}")) for side in "ab")
        edges = cut(edges.join(l, "a").join(r, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-edges")
        discard(*before)
    discard(edges)
    return labels
