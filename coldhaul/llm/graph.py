"""Connected components of an undirected graph, given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldhaul.session import cut


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node of its component.

    Each round hooks a node to its least smaller neighbour, shortens the ways upward twice and contracts the edges,
    so the rounds grow with the logarithm of the longest chain. Only minima are gathered per node, so a node of very
    many edges costs its task a combined row per other task. Rounds are written to the shared folder.
    """
    left = cut(_ordered(edges), "edges")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = nodes.select("node", F.col("node").alias("root"))
    while not left.isEmpty():
        up = left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        for _ in range(2):
            above = up.select(F.col("node").alias("up"), F.col("up").alias("above"))
            up = up.join(above, "up", "left").select("node", F.coalesce("above", "up").alias("up"))
        up = cut(up, "hooks")
        a = up.select(F.col("node").alias("a"), F.col("up").alias("to_a"))
        b = up.select(F.col("node").alias("b"), F.col("up").alias("to_b"))
        moved = left.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
        unfinished = up.select(F.col("up").alias("a")).distinct().join(a, "a").select("a", F.col("to_a").alias("b"))
        left = cut(_ordered(moved.union(unfinished)), "edges")
        hooks = up.select(F.col("node").alias("root"), "up")
        labels = labels.join(hooks, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return labels
