"""Connected components of an edge table that never leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.workspace import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for every node of an edge (``a``, ``b``).

    Each round hooks every node to its smallest neighbour below it, flattens the trees by pointer jumping, and
    contracts the edges to the roots; at least half of the nodes that still have an edge vanish per round.  A hub
    with many edges is combined before the shuffle and costs no more than its edges.  Loops and null ends are ignored.
    """
    def lower(e: DataFrame) -> DataFrame:
        return (e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    rest = materialize(lower(edges.select("a", "b").dropna()), "edges")
    labels = materialize(rest.select("a").union(rest.select("b")).distinct().select(
        F.col("a").alias("node"), F.col("a").alias("component")), "labels")
    while not rest.isEmpty():
        parents = rest.groupBy("a").agg(F.min("b").alias("p"))
        while True:
            parents = materialize(parents, "parents")
            up = parents.select(F.col("a").alias("p"), F.col("p").alias("_above"))
            parents = parents.join(up, "p", "left").select("a", F.coalesce("_above", "p").alias("p"), F.col("_above").isNotNull().alias("_moved"))
            parents = materialize(parents, "parents")
            moved = not parents.where("_moved").isEmpty()
            parents = parents.select("a", "p")
            if not moved:
                break
        to_root = parents.select(F.col("a").alias("component"), F.col("p").alias("_root"))
        labels = materialize(labels.join(to_root, "component", "left").select("node", F.coalesce("_root", "component").alias("component")), "labels")
        from_b = parents.select(F.col("a").alias("b"), F.col("p").alias("_pb"))
        # every remaining a has a parent; b may be a root
        rest = materialize(lower(rest.join(parents, "a").join(from_b, "b", "left").select(
            F.col("p").alias("a"), F.coalesce("_pb", "b").alias("b"))), "edges")
    return labels
