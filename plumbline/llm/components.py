"""Connected components of a graph given as edges, by contracting it until no edge is left.

In each round every node points at the smallest of its neighbours and itself, by an order that a hash deals anew, and on to where that one points.
The edges are then those between the nodes pointed at. Nodes that point nowhere are those smaller than all their neighbours, at most half of them
on average, whatever the shape of the graph: so the rounds grow with the logarithm of its size, and a chain is no worse than a star. The maps of the
rounds, each over fewer nodes than the one before, are then followed back to the first nodes.

Every round is written to the shared folder. A node with very many edges is met by aggregates that combine before the
shuffle; its rows in a join are split by Spark's handling of skewed joins, as each join has a side with one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import staged


def _between(edges: DataFrame) -> DataFrame:
    """The edges between different nodes, once each."""
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _contracted(edges: DataFrame, turn: int) -> DataFrame:
    """node, to: a node of the same component for every node of ``edges``, which have different ends."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = lambda name: F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("rank"), F.col(name).alias("node"))
    points = staged(both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("low")).select("node", F.least(rank("node"), "low")["node"].alias("to")))
    far = points.select(F.col("node").alias("at"), F.col("to").alias("far"))
    return staged(points.join(far, points["to"] == far["at"]).select("node", F.col("far").alias("to")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (a, b). No edges: no rows."""
    edges = staged(edges.select("a", "b"))
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    turns, left = [], staged(_between(edges))
    while not left.isEmpty():
        turns.append(_contracted(left, len(turns)))
        a, b = (turns[-1].select(F.col("node").alias(f"_{end}"), F.col("to").alias(f"to_{end}")) for end in "ab")
        left = staged(_between(left.join(a, left["a"] == a["_a"]).join(b, left["b"] == b["_b"]).select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))))
    if not turns:
        return staged(nodes.select("node", F.col("node").alias("component")))
    roots = turns.pop()
    while turns:        # a node that no edge is left for stays what it is
        further = roots.select(F.col("node").alias("at"), F.col("to").alias("root"))
        roots = turns.pop().join(further, F.col("to") == F.col("at"), "left").select("node", F.coalesce("root", "to").alias("to"))
        roots = staged(roots)
    least = roots.groupBy(F.col("to").alias("root")).agg(F.min("node").alias("component"))
    # Nodes whose only edges lead to themselves are in no turn.
    placed = staged(roots.join(least, F.col("to") == F.col("root")).select(F.col("node").alias("_node"), "component"))
    return staged(nodes.join(placed, nodes["node"] == placed["_node"], "left").select("node", F.coalesce("component", "node").alias("component")))
