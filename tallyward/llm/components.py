"""Connected components of a large graph by joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.store import Scratch


def components(edges: DataFrame, store: Scratch, name: str) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; a component bears its smallest node.

    Each round every node points at the smallest of itself and its neighbours, pointers
    are followed to their ends, and the edges are drawn anew between those ends, until
    none is left. A node of very many edges is a sum combined on the map side.
    """
    left = store.keep(edges.filter("a <> b").distinct(), f"{name}-edges-0")
    labels, turn = None, 0
    while not left.isEmpty():
        turn += 1
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("b"))
        points = store.keep(
            lowest.select(F.col("a").alias("node"), F.least("a", "b").alias("component")), f"{name}-points-{turn}"
        )
        hop = 0
        while True:
            ahead = points.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            onward = points.join(ahead, "component", "left").select(
                "node", F.coalesce("_next", "component").alias("component"), (F.col("_next") != F.col("component")).alias("_moved")
            )
            hop += 1
            moved = store.keep(onward, f"{name}-points-{turn}-{hop}")
            points = moved.select("node", "component")
            if moved.filter("_moved").isEmpty():
                break
        if labels is None:
            labels = points
        else:
            fresh = points.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            labels = labels.join(fresh, "component", "left").select("node", F.coalesce("_next", "component").alias("component"))
            labels = store.keep(labels, f"{name}-labels-{turn}")
        one = points.select(F.col("node").alias("a"), F.col("component").alias("_a"))
        two = points.select(F.col("node").alias("b"), F.col("component").alias("_b"))
        drawn = left.join(one, "a").join(two, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        left = store.keep(drawn.filter("a <> b").distinct(), f"{name}-edges-{turn}")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
