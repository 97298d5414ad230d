"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtload.llm.common import materialize


def _renamed(edges: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """Links between the new names of their ends, loops dropped."""
    for c in "ab":
        edges = edges.join(names.select(F.col("node").alias(c), F.col("component").alias(f"to_{c}")), c, how)
    a, b = (F.coalesce(f"to_{c}", c) for c in "ab")
    return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()


def contracted(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The links (a, b) that join two components of ``labels``, between these; written once."""
    edges = links.select("a", "b")
    return materialize(edges.where("a <> b").distinct() if labels is None else _renamed(edges, labels, "left"), "links")


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, component) of every node of ``contracted`` links and of ``labels``, the components before them;
    component is the smallest node reachable.

    Each round points every node at its smallest neighbour or itself, follows that pointer twice and
    contracts the links; what remains are local minima, so the rounds are few (about the logarithm of the
    longest path).  Rounds are cut by tables in the shared checkpoint folder.  The smallest neighbour is
    found by partial aggregation before the shuffle, and the joins of links and labels have plain exchanges
    on both sides.
    """
    empty = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("up")), "neighbours")
        step = materialize(near.join(near.select(F.col("node").alias("up"), F.col("up").alias("component")), "up")
                           .select("node", "component"), "pointers")
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("component"), F.col("component").alias("to"))
            new = step.join(labels.select("node"), "node", "left_anti")
            labels = materialize(labels.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")).unionByName(new), "labels")
        edges = contracted(_renamed(edges, step, "inner"))
    return empty if labels is None else labels
