"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkpipe.llm.frames import discard, written


def _to_lowest(links: DataFrame, upward: bool) -> DataFrame:
    """Tie the neighbours of each node to its lowest neighbour.

    ``upward``: those above the node, over all neighbours; else those below, and the
    node itself. Each is one aggregate and one join, and a node with very many links
    is only a crowded join key, which Spark splits.
    """
    low, high = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    if upward:
        sides = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"))
        sides = sides.select(F.col("x.a").alias("u"), F.col("x.b").alias("v"))
        lowest = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = sides.where("v > u").hint("merge").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        sides = links.select(high, low)
        lowest = sides.groupBy("u").agg(F.min("v").alias("m"))
        moved = sides.hint("merge").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node that has a link; root is the lowest node reachable.

    Links (a, b) are rewired to lower neighbours, from above and from below in turn,
    until every node hangs on its root; the number of rounds grows with the logarithm
    of the number of nodes. Each round is written to the shared folder, so a lost
    executor costs one round at most. A few sums reach the driver.
    """
    links = written(links.where("a != b").select("a", "b").distinct(), label)
    before = None
    while True:
        for upward in (True, False):
            last, links = links, written(_to_lowest(links, upward), label)
            discard(last)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
