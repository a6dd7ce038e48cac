"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camlytics.llm.common import dropped, stored


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(links: DataFrame) -> bool:
    """Whether every node that points anywhere points at one node that points nowhere."""
    several = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    passing = links.select(F.col("b").alias("a")).join(links.select("a"), "a", "left_semi")
    return several.unionByName(passing).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, root: for each node of the links (a, b) the smallest node reachable.

    Alternating stars: each node hands its neighbours the smallest node it
    knows, first the larger neighbours, then the smaller ones. Every step is a
    mergeable minimum and a join, so a node with very many links is split like
    any other skewed key. Each round goes on from a written table.
    """
    current = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(current):
        # Larger neighbours point at the smallest neighbour.
        around = _both(current)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Now each link leads down; smaller neighbours point at the smallest of them.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        )
        current, before = stored(small, "links"), current
        dropped(before)
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
