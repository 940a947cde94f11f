"""Dense parts of the payment graph: core numbers and a densest subgraph. Directions, loops and parallel payments don't count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import stored
from ledgerweb.operators.components import NotConverged
from ledgerweb.operators.graph import index_links, nodes

MAX_ROUNDS = 1000


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.inline(F.array(
        F.struct(F.col("lo").alias("v"), F.col("hi").alias("other")), F.struct(F.col("hi").alias("v"), F.col("lo").alias("other")))))


def core_numbers(e: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """`id, core` for every account: the largest k such that it is in a part where everyone has k neighbours or more.

    Accounts start from their neighbour count and, round by round, take the highest h of which h neighbours have h or more, until nobody
    moves; those are the core numbers (Lü et al., Nature Communications 2016). In a round only accounts with a neighbour that
    moved below them are looked at again. A hub's neighbours are counted by value before they meet, so it costs as many rows as there
    are values up to its own. Rounds follow how far a removal spreads: few in payment graphs, many along a single long chain.
    """
    index = index_links(e)
    sides = stored(_both_ways(index.links), "sides")
    cores = stored(sides.groupBy("v").agg(F.count(F.lit(1)).alias("core")), "cores")
    moved = cores.select("v", "core", F.lit(None).cast("bigint").alias("was"))
    for _ in range(max_rounds):
        # Whoever fell below a neighbour's value may pull it down; from at or below to lower makes no difference to it.
        told = sides.join(moved.withColumnRenamed("v", "other"), "other").join(cores.withColumnRenamed("core", "own"), "v")
        touched = stored(told.filter((F.col("core") < F.col("own")) & (F.col("was").isNull() | (F.col("was") >= F.col("own")))).select("v").distinct(), "touched")
        if touched.isEmpty():
            break
        heard = (
            sides.join(touched, "v", "left_semi").join(cores.withColumnRenamed("v", "other"), "other")
            .join(cores.withColumnRenamed("core", "own"), "v")
            .groupBy("v", "own", F.least("core", "own").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        )
        at_least = F.sum("n").over(W.partitionBy("v").orderBy(F.desc("value")))
        lower = heard.withColumn("h", F.least("value", at_least)).groupBy("v").agg(F.max("h").alias("h"), F.max("own").alias("own"))
        moved = stored(lower.filter("h < own").select("v", F.col("h").alias("core"), F.col("own").alias("was")), "moved")
        if moved.isEmpty():
            break
        cores = stored(
            cores.join(moved.select("v", F.col("core").alias("new")), "v", "left").select("v", F.coalesce("new", "core").alias("core")), "cores")
    else:
        raise NotConverged(f"core numbers did not settle within {max_rounds} rounds")
    linked = index.accounts.join(cores.withColumnRenamed("v", "vid"), "vid").select("id", "core")
    loops = nodes(e.filter(F.col("src") == F.col("dst"))).join(index.accounts.select("id"), "id", "left_anti")
    return linked.unionByName(loops.select("id", F.lit(0).cast("bigint").alias("core")))


def peeled(e: DataFrame, slack: float = 0.1, max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Batch peeling (Bahmani et al., PVLDB 2012): in each round everyone goes who has at most 2 * (1 + slack) times as many
    neighbours as there are links for each account.

    `id, round` with the round in which an account goes, and `round, accounts, links, density` as each round begins. At least a share of
    slack / (1 + slack) goes in each, so rounds grow with the logarithm of the accounts.
    """
    index = index_links(e)
    links, alive, left, rounds = index.links, index.accounts.select("vid"), [], []
    for turn in range(max_rounds):
        degrees = stored(alive.join(_both_ways(links).groupBy(F.col("v").alias("vid")).agg(F.count(F.lit(1)).alias("n")), "vid", "left")
                         .select("vid", F.coalesce("n", F.lit(0)).alias("n")), "degrees")
        accounts, ends = degrees.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not accounts:
            break
        rounds.append((turn, accounts, ends // 2, ends / 2 / accounts))
        stays = F.col("n") > F.lit(2 * (1 + slack)) * F.lit(ends // 2) / F.lit(accounts)
        left.append(degrees.filter(~stays).select("vid", F.lit(turn).alias("round")))
        alive = degrees.filter(stays).select("vid")
        links = stored(links.join(alive.withColumnRenamed("vid", "lo"), "lo", "left_semi").join(alive.withColumnRenamed("vid", "hi"), "hi", "left_semi"), "links")
    else:
        raise NotConverged(f"accounts were left after {max_rounds} rounds")
    gone = index.accounts.select("vid", F.lit(0).alias("round")).limit(0)
    for piece in left:
        gone = gone.unionByName(piece)
    table = e.sparkSession.createDataFrame(rounds, "round int, accounts long, links long, density double")
    return gone.join(index.accounts, "vid").select("id", "round"), table


def dense_subgraph(e: DataFrame, slack: float = 0.1) -> DataFrame:
    """`id, density`: the densest part that batch peeling meets; no part has more than 2 * (1 + slack) times its links for each account."""
    gone, rounds = peeled(e, slack)
    best = rounds.orderBy(F.desc("density"), "round").limit(1).select(F.col("round").alias("best"), "density")
    return gone.join(F.broadcast(best), F.col("round") >= F.col("best")).select("id", "density")
