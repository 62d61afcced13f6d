"""Connected components of a graph too large for one machine.

Large and small stars in turn: every node's larger neighbours are hung on its
smallest one, then its smaller ones. Both are a grouped minimum, combined before
its shuffle, and a merge join that adaptive execution can split, so a node with
a third of all links is no hot spot. Every round is written to the shared
folder. Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import stored


def components(links: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """``node, component`` for every node that has a link; a component is named by its smallest node.

    Links may repeat, point either way and lead to themselves; null ends are
    left out. Nodes are bigints.
    """
    ends = links.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    edges = ends.select(F.greatest(left, right).alias("node"), F.least(left, right).alias("to")).where("node > to")
    edges = stored(edges.distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        edges = _star(_star(edges, small=False), small=True)
        after = _mark(edges)
        if after == before:
            break
        before = after
    # All trees are stars now: every edge leads to the smallest node.
    roots = edges.select("to").distinct().select(F.col("to").alias("node"), F.col("to").alias("component"))
    return edges.select("node", F.col("to").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """What tells one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Edges hung on the smallest neighbour of each node: the smaller ones, or else the larger ones."""
    if small:
        around = edges
    else:
        around = edges.unionByName(edges.select(F.col("to").alias("node"), F.col("node").alias("to")))
    lowest = around.groupBy("node").agg(F.min("to").alias("low")).select(
        F.col("node").alias("centre"), F.least("node", "low").alias("low")
    )
    lowest = stored(lowest, "lowest")
    met = around.join(lowest.hint("merge"), F.col("node") == F.col("centre"))
    if small:
        moved = met.select(F.col("to").alias("node"), F.col("low").alias("to"))
        own = lowest.select(F.col("centre").alias("node"), F.col("low").alias("to"))
        moved = moved.unionByName(own)
    else:
        moved = met.where("to > node").select(F.col("to").alias("node"), F.col("low").alias("to"))
    return stored(moved.where("node > to").distinct(), "edges")
