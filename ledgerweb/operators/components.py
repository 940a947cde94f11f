"""Weakly connected components by star contraction.

Alternating large-star and small-star steps (Kiveris et al., SoCC 2014) on links that point from
child to parent, parents having the higher number. Since accounts are numbered by neighbour
count, hubs become parents and the first rounds already collapse most of the graph.

Every half round is one join and one aggregation, and is stored. The highest parents that it
joins are shuffled anew, so that adaptive execution can split a hub's partition in either step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import stored
from ledgerweb.functions.skew import reshuffled
from ledgerweb.operators.graph import LinkIndex, index_links, nodes

MAX_ROUNDS = 60


class NotConverged(RuntimeError):
    pass


def _highest_parent(links: DataFrame, name: str) -> DataFrame:
    return links.groupBy("lo").agg(F.max("hi").alias("top")).select(reshuffled("lo").alias(name), "top")


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every child below its parent's own highest parent."""
    hung = links.join(_highest_parent(links, "hi"), "hi", "left")
    return stored(hung.select("lo", F.coalesce("top", "hi").alias("hi")).distinct(), "large")


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a child and its other parents below the child's highest parent."""
    moves = F.col("hi") != F.col("top")
    hung = links.join(_highest_parent(links, "lo"), "lo")
    return stored(hung.select(F.when(moves, F.col("hi")).otherwise(F.col("lo")).alias("lo"), F.col("top").alias("hi")).distinct(), "small")


def _are_stars(links: DataFrame) -> bool:
    """Whether every child has one parent and no parent is a child: then each star is a component."""
    ends = links.select(F.inline(F.array(
        F.struct(F.col("lo").alias("vid"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("hi").alias("vid"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    per_account = ends.groupBy("vid").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_account.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def contract(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """`lo, hi`: one row per account that is not its component's root, with that root."""
    for _ in range(max_rounds):  # links that are stars from the start stay as they are in the first round
        links = _small_star(_large_star(links))
        if _are_stars(links):
            return links
    raise NotConverged(f"components did not settle within {max_rounds} rounds")


def _labelled(index: LinkIndex) -> tuple[DataFrame, DataFrame]:
    """Linked accounts with their component's root, and the components."""
    roots = contract(index.links)
    labelled = stored(
        index.accounts.join(roots.withColumnRenamed("lo", "vid"), "vid", "left")
        .select("id", F.coalesce("hi", "vid").alias("root")), "labelled")
    sizes = labelled.groupBy("root").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("cluster_size"))
    return labelled, sizes.select(reshuffled("root").alias("root"), "component", "cluster_size")


def _alone(e: DataFrame, index: LinkIndex) -> DataFrame:
    """Accounts that only pay themselves: they have no link and are components of their own."""
    loops = nodes(e.filter(F.col("src") == F.col("dst")))
    return loops.join(index.accounts.select("id"), "id", "left_anti")


def component_labels(e: DataFrame, index: LinkIndex | None = None) -> DataFrame:
    """`id, component, cluster_size`; the component is named after its smallest account id."""
    index = index or index_links(e)
    labelled, sizes = _labelled(index)
    linked = labelled.join(sizes, "root").select("id", "component", "cluster_size")
    return linked.unionByName(
        _alone(e, index).select("id", F.col("id").alias("component"), F.lit(1).cast("bigint").alias("cluster_size")))


def component_sizes(e: DataFrame, index: LinkIndex | None = None) -> DataFrame:
    """One row per component."""
    index = index or index_links(e)
    _, sizes = _labelled(index)
    return sizes.select("component", "cluster_size").unionByName(
        _alone(e, index).select(F.col("id").alias("component"), F.lit(1).cast("bigint").alias("cluster_size")))
