"""Connected components of an edge table by contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is one node of its component, the same for all of them.

    Each round every node points to its smallest neighbour (if smaller), pointers are followed a few steps, and the
    edges are moved to what their ends point to; a component that is one star collapses in one round. Every round's
    tables are written to the shared folder, and the loop ends when no edge is left between different nodes.
    """
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    left = stored(edges.select(*pair(F.col("a"), F.col("b"))).where("a < b").distinct(), "edges")
    labels = stored(left.select(F.col("a").alias("node")).union(left.select("b")).distinct().select("node", F.col("node").alias("root")), "labels")
    while not left.isEmpty():
        both = left.select(F.col("a").alias("u"), F.col("b").alias("v")).union(left.select("b", "a"))
        to = stored(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")), "pointers")
        for _ in range(2):
            ahead = to.select(F.col("u").alias("p"), F.col("p").alias("q"))
            to = stored(to.join(ahead, "p").select("u", F.col("q").alias("p")), "pointers")
        old, labels = labels, stored(labels.join(to, F.col("root") == F.col("u"), "left").select("node", F.coalesce("p", "root").alias("root")), "labels")
        dropped(old)
        of_a, of_b = to.select(F.col("u").alias("a"), F.col("p").alias("pa")), to.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        old, left = left, stored(left.join(of_a, "a").join(of_b, "b").select(*pair(F.col("pa"), F.col("pb"))).where("a < b").distinct(), "edges")
        dropped(old)
    return labels
