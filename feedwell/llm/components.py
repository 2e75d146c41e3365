"""Connected components of a graph given as links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwell.llm.shared import Scratch


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """node, label of every node with a link; nodes have equal labels when a path joins them.

    Each round points every node at its least neighbour, follows pointers twice, and keeps the links
    between what is still apart; their number at least halves in a few rounds whatever the paths'
    lengths. Links are combined before they are shuffled, so a node with many of them is no burden.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = scratch.table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = scratch.table(both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")))
        for _ in range(2):
            above = parents.select(F.col("a").alias("p"), F.col("p").alias("q"))
            parents = parents.join(above, "p").select("a", F.col("q").alias("p"))
        parents = scratch.table(parents)
        named = parents.select(F.col("a").alias("label"), "p")
        labels = labels.join(named, "label", "left").select("node", F.coalesce("p", "label").alias("label"))
        labels = scratch.table(labels)
        left = edges.join(parents, "a").select(F.col("p").alias("x"), "b")
        moved = left.join(parents.withColumnRenamed("a", "b"), "b").select("x", F.col("p").alias("y")).filter("x <> y")
        edges = scratch.table(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return labels
