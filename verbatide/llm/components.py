"""Connected components over an edge table, by rounds of random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.storage import cut_lineage


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another; one root per component.

    In each round a node moves to the neighbour that comes first in the round's order
    (itself included), edges are rewritten to the new ends, and loops go. Every other
    round's order is that of the nodes' values, which takes stars around their smallest
    node at once; the rounds between draw one anew, by which a fixed share of the nodes
    goes, also on long chains. So rounds grow with the logarithm of the longest chain.
    Nothing but whether edges are left reaches the driver. Rows with a null end link
    nothing.
    """
    live = cut_lineage(
        edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
        .filter(F.col("a") != F.col("b"))
    )
    turn, roots = 0, None
    while not live.isEmpty():
        order = lambda c, t=turn: F.xxhash64(F.lit(t), c) if t % 2 else c
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(F.struct(order(F.col("b")).alias("o"), "b")).alias("m"))
        to = F.when(F.struct(order(F.col("a")).alias("o"), F.col("a").alias("b")) < F.col("m"), F.col("a"))
        move = cut_lineage(first.select("a", F.coalesce(to, F.col("m.b")).alias("to")))
        # Each move is folded into the roots at once: two tables, however many rounds.
        if roots is None:
            roots = move.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = move.select(F.col("a").alias("root"), "to")
            moved = roots.join(step, "root", "left")
            roots = cut_lineage(moved.select("node", F.coalesce("to", "root").alias("root")))
        live = cut_lineage(
            live.join(move, "a")
            .select(F.col("to").alias("x"), F.col("b").alias("a"))
            .join(move, "a")
            .filter(F.col("x") != F.col("to"))
            .select(F.col("x").alias("a"), F.col("to").alias("b"))
        )
        turn += 1
    if roots is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
