"""Triangles through every account.

Links point from accounts with fewer neighbours to those with more, by size class, so no account has
more than 2 * sqrt(links) outgoing ones, hubs included (after Suri and Vassilvitskii, WWW 2011). The third
corner of a triangle on link (lo, hi) is an account both point to: the intersection of their
two outgoing lists. The list of `hi` travels to `lo`, one for each link: these are the pairs of neighbours, packed.
(Sending whichever list is shorter was measured to save a tenth of the volume and cost two more joins.)
Lists are cut into chunks by a hash of the head, which bounds a row whatever the account.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.functions.skew import reshuffled, spread
from ledgerweb.operators.graph import LinkIndex, index_links

CHUNK = 4096  # heads of a row, about


def _chunks(links: DataFrame, chunk: int) -> int:
    """As many chunks for every account, so that two lists' chunks meet; most accounts fill few of them."""
    longest = math.isqrt(4 * links.count()) + 1
    return -(-longest // chunk)


def _by_tail(links: DataFrame, chunks: int) -> GroupedData:
    return links.groupBy(F.col("lo").alias("v"), F.pmod(F.xxhash64("hi"), F.lit(chunks)).alias("chunk"))


def closing_corners(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """`lo, hi, corners`: every triangle once, on the link of its two lowest accounts.

    Rows without a triangle may stay, with an empty list: a filter on it would be evaluated inside the
    join, and the intersection would then be computed twice.
    """
    chunks = _chunks(links, chunk)
    lists = _by_tail(links, chunks).agg(F.collect_list("hi").alias("heads"))
    # An account that many links point to has few outgoing ones, so it is its short list that travels.
    of_hi = lists.select(reshuffled("v").alias("hi"), "chunk", F.col("heads").alias("carried"))
    of_lo = lists.select(reshuffled("v").alias("lo"), "chunk", "heads").filter((F.size("heads") >= 2) | F.lit(chunks > 1))
    return (
        links.join(of_hi, "hi").join(of_lo, ["lo", "chunk"])
        .select("lo", "hi", F.array_intersect("heads", "carried").alias("corners"))
    )


def fresh_corners(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The same for the triangles that have a `fresh` link, a mark of `links`: at least one of the three.

    A fresh link is closed by all common heads of its ends, another by those to which one of its ends has a fresh link. So of `hi` all heads travel where the
    link is fresh or `lo` has a fresh one, and else the fresh ones only, most often none. At the most, where every
    account has a fresh link, this is what `closing_corners` sends.
    """
    chunks = _chunks(links, chunk)
    lists = _by_tail(links, chunks).agg(
        F.collect_list("hi").alias("heads"), F.collect_list(F.when(F.col("fresh"), F.col("hi"))).alias("fresh_heads"))
    of_hi = lists.select(reshuffled("v").alias("hi"), "chunk", F.col("heads").alias("carried"), F.col("fresh_heads").alias("fresh_carried"))
    of_lo = lists.select(reshuffled("v").alias("lo"), "chunk", "heads", "fresh_heads").filter((F.size("heads") >= 2) | F.lit(chunks > 1))
    near_fresh = F.max("fresh").over(W.partitionBy("lo"))
    none = F.array().cast("array<bigint>")
    sent = (
        links.withColumn("near_fresh", near_fresh).join(of_hi, "hi").filter(F.col("near_fresh") | (F.size("fresh_carried") > 0))
        .select("lo", "hi", "chunk", "fresh", F.when(F.col("near_fresh"), F.col("carried")).otherwise(none).alias("carried"),
                F.when(F.col("fresh"), none).otherwise(F.col("fresh_carried")).alias("fresh_carried"))
    )
    closed = F.when(F.col("fresh"), F.array_intersect("heads", "carried")).otherwise(
        F.array_union(F.array_intersect("fresh_heads", "carried"), F.array_intersect("heads", "fresh_carried")))
    return spread(sent, "lo", "chunk").join(of_lo, ["lo", "chunk"]).select("lo", "hi", closed.alias("corners"))


def triangles_by_vid(links: DataFrame) -> DataFrame:
    return _of_corners(closing_corners(links))


def _of_corners(found: DataFrame) -> DataFrame:
    """`vid, triangle_count` from triangles as lists of third corners."""
    size = F.size("corners").cast("bigint")
    shares = F.concat(
        F.array(F.struct(F.col("lo").alias("vid"), size.alias("n")),
                F.struct(F.col("hi").alias("vid"), size.alias("n"))),
        F.transform("corners", lambda c: F.struct(c.alias("vid"), F.lit(1).cast("bigint").alias("n"))),
    )
    counted = found.select(F.inline(shares)).groupBy("vid").agg(F.sum("n").alias("triangle_count"))
    return counted.filter("triangle_count > 0")


def triangle_counts(e: DataFrame, index: LinkIndex | None = None) -> DataFrame:
    """`id, triangle_count` for accounts in at least one triangle."""
    index = index or index_links(e)
    return triangles_by_vid(index.links).join(index.accounts, "vid").select("id", "triangle_count")


def fresh_triangle_counts(index: LinkIndex) -> DataFrame:
    """`id, triangle_count` of triangles with a fresh link, for accounts in at least one; the index's links have the mark `fresh`."""
    return _of_corners(fresh_corners(index.links)).join(index.accounts, "vid").select("id", "triangle_count")
