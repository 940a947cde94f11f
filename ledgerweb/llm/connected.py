"""Connected components by alternating stars, on DataFrames alone.

A link points from a node to a smaller one. The large star hangs every node below its parent's smallest parent, the small
star hangs a node's parents and the node itself below the smallest of them (Kiveris et al., SoCC 2014). Each half
round is stored, with the smallest parents in a table of their own: both sides of each join then come straight
from a shuffle, so that adaptive execution can split a node that has a third of all links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm.common import stored

MAX_ROUNDS = 60


def _smallest(links: DataFrame) -> DataFrame:
    return stored(links.groupBy("node").agg(F.min("parent").alias("top")), "parents")


def roots(links: DataFrame) -> DataFrame:
    """`node, root` for every node of `links(a, b)` that is not the smallest of its component.

    Links may repeat and point either way; a link of a node with itself or with null is ignored.
    """
    links = stored(
        links.filter("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent")).distinct(), "links")
    if links.isEmpty():
        return links.withColumnRenamed("parent", "root")
    for _ in range(MAX_ROUNDS):
        of_parent = _smallest(links).withColumnRenamed("node", "parent")
        large = stored(
            links.join(of_parent, "parent", "left")
            .groupBy("node", F.coalesce("top", "parent").alias("parent"))
            .agg(F.bool_or(F.col("top").isNotNull()).alias("moved")), "large")
        moves = F.col("parent") != F.col("top")
        small = stored(
            large.join(_smallest(large), "node")
            .groupBy(F.when(moves, F.col("parent")).otherwise(F.col("node")).alias("node"), F.col("top").alias("parent"))
            .agg(F.bool_or(F.col("moved") | moves).alias("moved")), "small")
        links = small.select("node", "parent")
        if small.filter("moved").isEmpty():
            return links.withColumnRenamed("parent", "root")
    raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
