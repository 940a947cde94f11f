"""Transactions as a weighted directed graph: `edges(src, dst, transaction_count, total_amount)`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.amounts import money, money_sum, money_sum_if
from ledgerweb.functions.lineage import cut, stored
from ledgerweb.functions.ordered import global_rank


def edges(tx: DataFrame) -> DataFrame:
    """One row per ordered pair of accounts."""
    return (
        tx.groupBy(F.col("sender").alias("src"), F.col("receiver").alias("dst"))
        .agg(F.count(F.lit(1)).alias("transaction_count"), money_sum("amount").alias("total_amount"))
    )


def endpoints(e: DataFrame, *carry: str) -> DataFrame:
    """Each edge twice, once per end: `id`, `is_out` and the carried columns."""
    return e.select(
        *carry,
        F.inline(F.array(
            F.struct(F.col("src").alias("id"), F.lit(True).alias("is_out")),
            F.struct(F.col("dst").alias("id"), F.lit(False).alias("is_out")),
        )),
    )


def nodes(tx: DataFrame) -> DataFrame:
    """Distinct senders and receivers."""
    return (
        tx.select(F.explode(F.array("sender", "receiver")).alias("id")).distinct()
        if "sender" in tx.columns
        else tx.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    )


def account_pool(tx: DataFrame, salt: str = "pool") -> DataFrame:
    """All accounts with their `place`, from 0, in the order of a hash of the id.

    Neighbouring places are a random draw without replacement.
    """
    hashed = nodes(tx).withColumn("hash", F.md5(F.concat_ws(":", F.lit(salt), "id")))
    return global_rank(hashed, [F.col("hash"), F.col("id")]).select("id", (F.col("rank") - 1).alias("place"))


def additive_features(e: DataFrame) -> DataFrame:
    """Degree, transaction counts and amounts of every account in one aggregation of the edge ends."""
    # Amounts become decimals once for each edge, not for either end.
    return features_of_ends(endpoints(e.withColumn("total_amount", money("total_amount")), "transaction_count", "total_amount"))


def features_of_ends(ends: DataFrame) -> DataFrame:
    """The same from edge ends, rows of `id, is_out, transaction_count, total_amount`."""
    out = F.col("is_out")
    return (
        ends.groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("degree"),
            F.sum(F.when(~out, F.col("transaction_count")).otherwise(0)).alias("tx_count_in"),
            F.sum(F.when(out, F.col("transaction_count")).otherwise(0)).alias("tx_count_out"),
            F.round(money_sum_if(~out, "total_amount"), 4).alias("amount_in"),
            F.round(money_sum_if(out, "total_amount"), 4).alias("amount_out"),
        )
    )


def degree(e: DataFrame) -> DataFrame:
    """In, out and total degree; a self-loop counts on both sides."""
    return (
        endpoints(e).groupBy("id")
        .agg(F.count_if(~F.col("is_out")).alias("in_degree"), F.count_if(F.col("is_out")).alias("out_degree"))
        .withColumn("degree", F.col("in_degree") + F.col("out_degree"))
    )


def hubs(e: DataFrame, threshold: int = 10) -> DataFrame:
    return degree(e).filter(F.col("degree") > threshold).select("id", "degree")


def top_edges(e: DataFrame, k: int = 2000) -> DataFrame:
    return e.orderBy(F.desc("transaction_count"), "src", "dst").limit(k)


def top_hubs(e: DataFrame, k: int = 40) -> DataFrame:
    return degree(e).select("id", "degree").orderBy(F.desc("degree"), "id").limit(k)


def induced(e: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges with both ends among `kept.id`."""
    ids = kept.select("id")
    return (
        e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
        .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    )


def top_hub_subgraph(e: DataFrame, k_nodes: int = 40, k_edges: int | None = None) -> DataFrame:
    """The best-connected accounts and the edges among them; with `k_edges` within that many heaviest edges."""
    kept = cut(e if k_edges is None else top_edges(e, k_edges))
    return induced(kept, top_hubs(kept, k_nodes)).select("src", "dst", "transaction_count", "total_amount")


def viz_nodes(e: DataFrame, threshold: int = 10) -> DataFrame:
    """Node table of a drawing: label, and red for accounts above the degree threshold."""
    return degree(e).select(
        "id", F.col("id").alias("label"),
        F.when(F.col("degree") > threshold, "red").alias("color"),
    )


def viz_edges(e: DataFrame) -> DataFrame:
    """Edge table of a drawing: width and tooltip, whose wording is fixed."""
    return e.select(
        "src", "dst", F.col("transaction_count").alias("value"),
        F.concat(
            F.lit("Txns: "), F.col("transaction_count").cast("string"),
            F.lit(", Amt: "), F.col("total_amount").cast("decimal(30,2)").cast("string"),
        ).alias("title"),
    )


def undirected(e: DataFrame) -> DataFrame:
    """Unordered pairs `a < b`: reciprocal edges merged, self-loops left out."""
    return (
        e.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .distinct()
    )


def neighbor_counts(e: DataFrame) -> DataFrame:
    """Distinct accounts on the other end, whatever the direction; 0 for a pure self-loop."""
    und = undirected(e).select(F.explode(F.array("a", "b")).alias("id"), F.lit(1).alias("n"))
    loops = e.filter(F.col("src") == F.col("dst")).select(F.col("src").alias("id"), F.lit(0).alias("n"))
    return und.unionByName(loops).groupBy("id").agg(F.sum("n").alias("neighbor_count"))


def reciprocal_pairs(e: DataFrame) -> DataFrame:
    """Pairs that pay each other, found by grouping both directions on the unordered pair."""
    forward = F.col("src") < F.col("dst")
    return (
        e.filter(F.col("src") != F.col("dst"))
        .groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("directions"),
            F.sum(F.when(forward, F.col("transaction_count")).otherwise(0)).alias("tx_ab"),
            F.sum(F.when(~forward, F.col("transaction_count")).otherwise(0)).alias("tx_ba"),
        )
        .filter("directions = 2").drop("directions")
    )


def reciprocal_counts(e: DataFrame) -> DataFrame:
    """Number of reciprocal partners per account that has any."""
    return (
        reciprocal_pairs(e).select(F.explode(F.array("a", "b")).alias("id"))
        .groupBy("id").agg(F.count(F.lit(1)).alias("reciprocal_count"))
    )


def flow_signals(features: DataFrame, out_in_ratio: float = 10.0) -> DataFrame:
    """The documented suspicion signals of an account's money flow."""
    ratio = F.try_divide("amount_out", "amount_in")
    flagged = features.withColumn("out_in_ratio", F.round(ratio, 6)).withColumn(
        "only_sends", (F.col("tx_count_out") > 0) & (F.col("tx_count_in") == 0)
    ).withColumn(
        "disproportionate",
        (F.col("amount_out") > 0)
        & ((F.col("amount_in") == 0) | (F.coalesce(ratio, F.lit(0.0)) > out_in_ratio)),
    )
    if "cluster_size" in features.columns:
        flagged = flagged.withColumn("isolated_cluster", F.col("cluster_size") == 1)
    if "triangle_count" in features.columns:
        flagged = flagged.withColumn("no_triangles", F.col("triangle_count") == 0)
    return flagged


class LinkIndex:
    """The undirected graph with accounts numbered for the iterative operators.

    `accounts(vid, id)` numbers accounts by ascending size class, the bits of their neighbour count, in no order
    within a class: no sort is needed, and with twice the neighbours an account has the higher number. `links(lo, hi)`
    holds each pair once with lo < hi; no account has more than 2 * sqrt(links) higher ones. Both are stored, because the numbers must not change when a
    lost executor's work is repeated. Accounts that only pay themselves are not in it.
    """

    def __init__(self, accounts: DataFrame, links: DataFrame):
        self.accounts = accounts
        self.links = links


def index_links(e: DataFrame) -> LinkIndex:
    return index_of(undirected(e))


def index_of(pairs: DataFrame) -> LinkIndex:
    """The same from unordered pairs `a, b`, each of which is there once; columns besides stay with the links."""
    carry = [c for c in pairs.columns if c not in ("a", "b")]
    und = stored(pairs, "undirected")
    counts = und.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    size_class = F.floor(F.log2("n")).cast("bigint")
    accounts = stored(
        counts.select("id", F.shiftleft(size_class, 57).bitwiseOR(F.monotonically_increasing_id()).alias("vid")), "accounts")
    of_a = accounts.select(F.col("id").alias("a"), F.col("vid").alias("va"))
    of_b = accounts.select(F.col("id").alias("b"), F.col("vid").alias("vb"))
    links = stored(
        und.join(of_a, "a").join(of_b, "b").select(F.least("va", "vb").alias("lo"), F.greatest("va", "vb").alias("hi"), *carry), "links")
    return LinkIndex(accounts, links)
