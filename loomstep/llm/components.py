"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node that links reach.

    Each round hooks every node to its smallest neighbour, follows the hooks one step further and
    contracts the edges, so the number of edges falls at least by half of the nodes that are left.
    Minima are aggregated before the shuffle, so a hub does not gather its neighbours in one task.
    Null ends and loops are left out; an empty table gives an empty result.
    """
    left = materialize(
        edges.select(F.least(F.col(a), F.col(b)).alias("a"), F.greatest(F.col(a), F.col(b)).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "edges",
    )
    ends = lambda e: e.select(F.col("a").alias("node"), F.col("b").alias("to")).union(e.select("b", "a"))
    labels = None
    while not left.isEmpty():
        hook = ends(left).groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("up"))
        hook = materialize(hook, "hooks")
        over = hook.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        hook2 = materialize(hook.join(over, "up").select("node", F.col("upper").alias("up")), "hooks")
        discard(hook)
        after = (
            left.join(hook2.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            .join(hook2.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        after = materialize(after, "edges")
        if labels is None:
            labels = hook2.select("node", F.col("up").alias("component"))
        else:
            step = hook2.select(F.col("node").alias("component"), "up")
            moved = labels.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            moved = materialize(moved, "labels")
            discard(labels)
            discard(hook2)
            labels = moved
        discard(left)
        left = after
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("component"))
