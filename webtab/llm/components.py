"""Connected components of a graph by contraction.

In each round every node points to the neighbour (or itself) that comes first
in an order drawn by hash anew for the round; edges are then rewritten to those
targets, loops and repeats dropped. Paths lose about half of their nodes per
round, stars vanish at once, so the number of rounds grows with the logarithm
of the graph. Each round is written to the shared folder. The labels are put
together backwards through the rounds. Nothing but the count of remaining edges
reaches the driver. Joins on a hub rely on adaptive skew splitting: all of them are
plain joins on one key with one row per key on the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtab.session import cut


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), both of one type, to (node, label) for every node that has an edge to another one.

    Repeated edges and loops are allowed; the label is one node of the component.
    """
    left = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        order = F.xxhash64(F.col("to"), F.lit(len(steps)))
        both = left.select(F.col("a").alias("node"), F.explode(F.array("b", "a")).alias("to")).unionByName(
            left.select(F.col("b").alias("node"), F.explode(F.array("a", "b")).alias("to")))
        step = cut(both.groupBy("node").agg(F.min(F.struct(order.alias("rank"), "to")).alias("first"))
                   .select("node", F.col("first.to").alias("to")), "step")
        steps.append(step)
        a = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        b = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = left.join(a, "a").join(b, "b").where("x <> y")
        left = cut(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    found = steps[-1].select("node", F.col("to").alias("label"))
    for step in reversed(steps[:-1]):
        later = found.select(F.col("node").alias("to"), "label")
        found = step.join(later, "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    return found
