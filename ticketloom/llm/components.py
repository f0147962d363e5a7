"""Connected components by distributed union-find, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.shared import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of ``edges(a, b)``; a component is named by its smallest node.

    Each round hangs every node on its smallest neighbour, doubles the paths until
    they end at roots and contracts the edges to these, so long chains and large stars
    take few rounds. A node's minimum is combined before the shuffle; the joins read
    checkpointed tables, so adaptive execution may split a hot node. Self-links and
    NULL ends are dropped, repeated links count once.
    """
    edges = checkpointed(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct()
    )
    labels = None
    while not edges.isEmpty():
        parents = checkpointed(
            edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .groupBy(F.col("a").alias("node"))
            .agg(F.least(F.min("b"), F.col("node")).alias("parent"))
        )
        parents = _roots(parents)
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("component"))
        else:
            moved = parents.select(F.col("node").alias("component"), "parent")
            labels = checkpointed(
                labels.join(moved, "component", "left").select(
                    "node", F.coalesce("parent", "component").alias("component")
                )
            )
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = checkpointed(
            edges.join(of_a, "a")
            .join(of_b, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _roots(parents: DataFrame) -> DataFrame:
    """``(node, parent)`` with the root of each node's tree: a path of length n takes log n joins."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        above = checkpointed(parents.join(up, "parent").select("node", "parent", "above"))
        parents = above.select("node", F.col("above").alias("parent"))
        if above.where("parent <> above").isEmpty():
            return parents
