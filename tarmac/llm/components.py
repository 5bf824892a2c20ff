"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.shared import Stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours to the smallest node around: the larger ones, or the smaller and itself.

    Minima combine before the shuffle, and the edges of a hub are joined to one row, which
    adaptive execution can split: no task needs all neighbours of a node.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, stage: Stage, name: str = "components") -> DataFrame:
    """(node, root) of every node that has an edge; the root is its component's smallest node.

    ``edges`` has the columns a and b. Loops and repeated edges change nothing. Rounds grow with
    the logarithm of the longest path; each round's edges are a written table.
    """
    current = stage.table(f"{name}-0", edges.select("a", "b").where("a <> b").distinct())
    before, round_ = None, 0
    while True:
        now = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")
        ).first()
        if now == before or not now.n:
            break
        before, round_ = now, round_ + 1
        current = stage.table(f"{name}-{round_}", _star(_star(current, True), False))
        stage.drop(f"{name}-{round_ - 1}")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
