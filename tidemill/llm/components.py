"""Connected components of a graph of links, by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.llm.staging import staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    ways = _both_ways(links)
    least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _unsettled(links: DataFrame) -> DataFrame:
    """Nodes that stand in the way of stars: those under several others, and those that are under one and above one."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("under"), F.lit(0).alias("above")).union(links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("under").alias("under"), F.max("above").alias("above")).where("under > 1 or (under = 1 and above = 1)")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: every linked node but the roots, with the smallest node of its component.

    Each round is written to the shared folder.  A round is the last if every node is linked to a single smaller one that is
    a root: these stars are the components.  Loops and repeated links are ignored; an empty table gives an empty one.
    """
    now = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct()
    while True:
        now = staged(_small_star(_large_star(now)), "components")
        if _unsettled(now).limit(1).count() == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
