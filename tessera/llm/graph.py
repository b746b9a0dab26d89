"""Connected components by label contraction.

Every round takes, for each node, the least of itself and its neighbours, follows that pointer
once more, replaces both ends of every edge, and drops loops and repeats. The edge table shrinks
geometrically on usual graphs, and each round's tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import written


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``edges(a, b)`` to ``(node, root)``; root is the least node of its component.

    Loops, repeats and both directions are allowed; edges with a null end are ignored. Nodes
    without an edge to another node don't appear. No edges: an empty table.
    """
    edges = written(_distinct(edges.where("a is not null and b is not null")), "edges")
    roots = None
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("up")), "pointers")
        above = near.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jump = written(near.join(above, "up", "left").select("node", F.least("up", F.coalesce("top", "up")).alias("up")), "jumps")
        at_a = jump.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        at_b = jump.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = written(_distinct(edges.join(at_a, "a").join(at_b, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b"))), "edges")
        if roots is None:
            roots = jump.select("node", F.col("up").alias("root"))
        else:
            moved = jump.select(F.col("node").alias("root"), F.col("up").alias("to"))
            roots = written(roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
