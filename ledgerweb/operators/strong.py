"""Strongly connected components by colours, forwards and backwards.

Every account hands the highest number it has heard of to those it pays, until nobody hears of a higher one: the accounts of one
colour are those that their highest one reaches. Of these, the ones that reach it in turn are its component. They
leave, as do arcs between colours, and the rest begins anew. Accounts are numbered by neighbour count, so that the
largest component mostly goes first, and in each turn all colours are worked on at once.

In both directions only accounts that changed speak, and every round is stored. Rounds follow the number of steps between the
accounts of a component, not its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import stored
from ledgerweb.operators.components import NotConverged
from ledgerweb.operators.graph import index_links, nodes

MAX_TURNS = 100
MAX_ROUNDS = 1000
TRIM_ROUNDS = 3
MERGE_EVERY = 16  # rounds after which what was found in each is stored as one


def _trimmed(arcs: DataFrame, rounds: int = TRIM_ROUNDS) -> DataFrame:
    """Arcs without those that lead to an account without a way on, or come from one without a way in.

    This makes the rounds to come smaller; what is left over is found to be alone by the colours as well.
    """
    for _ in range(rounds):
        paid = arcs.select(F.col("t").alias("s")).distinct()
        paying = arcs.select(F.col("s").alias("t")).distinct()
        arcs = stored(arcs.join(paid, "s", "left_semi").join(paying, "t", "left_semi"), "trimmed")
    return arcs


def _coloured(arcs: DataFrame, max_rounds: int) -> DataFrame:
    """`v, colour`: the highest number that reaches each account over `arcs(s, t)`."""
    labels = stored(
        arcs.select(F.explode(F.array("s", "t")).alias("v")).distinct().select("v", F.col("v").alias("colour"), F.lit(True).alias("moved")), "colours")
    for _ in range(max_rounds):
        moved = labels.filter("moved").select(F.col("v").alias("s"), "colour")
        if moved.isEmpty():
            return labels.select("v", "colour")
        heard = arcs.join(moved, "s").groupBy(F.col("t").alias("v")).agg(F.max("colour").alias("heard"))
        labels = stored(labels.join(heard, "v", "left").select(
            "v", F.greatest("colour", "heard").alias("colour"), F.coalesce(F.col("heard") > F.col("colour"), F.lit(False)).alias("moved")), "colours")
    raise NotConverged(f"colours did not settle within {max_rounds} rounds")


def _reaching(arcs: DataFrame, found: DataFrame, max_rounds: int) -> DataFrame:
    """`v, colour`: the given accounts and all that reach them over `arcs(s, t, colour)`."""
    moved = found
    for turn in range(max_rounds):
        heard = arcs.join(moved.select(F.col("v").alias("t")), "t").select(F.col("s").alias("v"), "colour").distinct()
        moved = stored(heard.join(found.select("v"), "v", "left_anti"), "reaching")
        if moved.isEmpty():
            return found
        found = found.unionByName(moved)
        if turn % MERGE_EVERY == MERGE_EVERY - 1:
            found = stored(found, "reached")
    raise NotConverged(f"components did not close within {max_rounds} rounds")


def _roots(arcs: DataFrame, max_turns: int, max_rounds: int) -> list[DataFrame]:
    """Stored pieces of `v, colour`: the accounts of each component of two or more, with its highest number."""
    pieces = []
    for _ in range(max_turns):
        arcs = _trimmed(arcs)
        if arcs.isEmpty():
            return pieces
        labels = _coloured(arcs, max_rounds)
        of_s = labels.select(F.col("v").alias("s"), "colour")
        of_t = labels.select(F.col("v").alias("t"), F.col("colour").alias("other"))
        inner = stored(arcs.join(of_s, "s").join(of_t, "t").filter("colour = other").select("s", "t", "colour"), "inner")
        done = _reaching(inner, stored(labels.filter("v = colour"), "pivots"), max_rounds)
        pieces.append(done)
        gone = done.select("v")
        arcs = stored(
            inner.join(gone.withColumnRenamed("v", "s"), "s", "left_anti").join(gone.withColumnRenamed("v", "t"), "t", "left_anti").select("s", "t"), "left")
    raise NotConverged(f"components were left after {max_turns} turns")


class StrongIndex:
    """`accounts(vid, id)`, numbered by neighbour count, and `roots(vid, root)` for accounts that lie on a cycle."""

    def __init__(self, accounts: DataFrame, roots: DataFrame, arcs: DataFrame):
        self.accounts = accounts
        self.roots = roots
        self.arcs = arcs


def strong_index(e: DataFrame, max_turns: int = MAX_TURNS, max_rounds: int = MAX_ROUNDS) -> StrongIndex:
    arcs = e.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()
    accounts = index_links(arcs).accounts
    numbered = stored(
        arcs.join(accounts.select(F.col("id").alias("src"), F.col("vid").alias("s")), "src")
        .join(accounts.select(F.col("id").alias("dst"), F.col("vid").alias("t")), "dst").select("s", "t"), "arcs")
    pieces = _roots(numbered, max_turns, max_rounds)
    # A pivot that nobody reaches is a component of its own.
    empty = numbered.select(F.col("s").alias("v"), F.col("t").alias("colour")).limit(0)
    found = stored(reduce(DataFrame.unionByName, pieces, empty), "strong")
    large = found.groupBy("colour").count().filter("count > 1").select("colour")
    roots = stored(found.join(large, "colour").select(F.col("v").alias("vid"), F.col("colour").alias("root")), "roots")
    return StrongIndex(accounts, roots, numbered)


def strong_components(e: DataFrame, index: StrongIndex | None = None) -> DataFrame:
    """`id, component, component_size` for every account; a component is named after its smallest account id."""
    index = index or strong_index(e)
    labelled = stored(
        index.accounts.join(index.roots, "vid", "left").select("id", F.coalesce("root", "vid").alias("root")), "labelled")
    sizes = stored(labelled.groupBy("root").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("component_size")), "sizes")
    loops = nodes(e.filter(F.col("src") == F.col("dst"))).join(index.accounts.select("id"), "id", "left_anti")
    return labelled.join(sizes, "root").select("id", "component", "component_size").unionByName(
        loops.select("id", F.col("id").alias("component"), F.lit(1).cast("bigint").alias("component_size")))


def inner_arcs(index: StrongIndex) -> DataFrame:
    """`s, t`: the arcs within components, which are those that lie on a cycle."""
    of_s = index.roots.select(F.col("vid").alias("s"), F.col("root").alias("of_s"))
    of_t = index.roots.select(F.col("vid").alias("t"), F.col("root").alias("of_t"))
    return index.arcs.join(of_s, "s").join(of_t, "t").filter("of_s = of_t").select("s", "t")
