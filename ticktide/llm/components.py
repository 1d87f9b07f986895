"""Connected components of a table of links, by large-star and small-star steps.

Every step rewires links to the smallest neighbour; the number of links never
grows beyond that of the start, and the rounds are logarithmic in the number of
nodes. Only a count and a sum of hashes reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ticktide.llm.tables import checkpointed


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to (node, root): the smallest node that each linked node reaches.

    Nodes without a link, and links with a null end or from a node to itself,
    are left out. An empty table gives an empty table.
    """
    now = checkpointed(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = _smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(smallest, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = checkpointed(large)
        smallest = _smallest(large)
        small = large.join(smallest, "a").filter(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        now = checkpointed(small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct())
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
