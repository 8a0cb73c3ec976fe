"""Connected components by contraction: every round, each node goes to its smallest neighbour.

The edges between the merged nodes go on to the next round, so they become fewer, and a round
only groups and joins; the rounds' steps are put together once at the end. Nodes are longs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); a root stands for one component."""
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = written(ends.where("a <> b").distinct(), "edges")
    roots = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    roots = roots.select("node", F.col("node").alias("root"))
    while left.limit(1).count():
        both = left.union(left.select("b", "a"))
        step = both.groupBy(F.col("a").alias("root")).agg(F.least(F.col("a"), F.min("b")).alias("to"))
        step = written(step, "step")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        near = left.join(step.select(F.col("root").alias("a"), F.col("to").alias("x")), "a")
        near = near.join(step.select(F.col("root").alias("b"), F.col("to").alias("y")), "b")
        left = written(
            near.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
    return written(roots, "roots")
