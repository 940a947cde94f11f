"""What spreads over the payment graph: risk from labelled accounts, and community labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import stored
from ledgerweb.functions.ordered import global_rank
from ledgerweb.operators.components import NotConverged
from ledgerweb.operators.graph import nodes


def _numbered(e: DataFrame, weight: str) -> tuple[DataFrame, DataFrame]:
    """Stored `accounts(vid, id)`, numbered in the order of their ids, and `arcs(s, t, weight)`, not stored."""
    accounts = stored(global_rank(nodes(e), [F.col("id")], "vid").select("vid", "id"), "accounts")
    arcs = (
        e.select("src", "dst", F.col(weight).cast("double").alias("weight"))
        .join(accounts.select(F.col("id").alias("src"), F.col("vid").alias("s")), "src")
        .join(accounts.select(F.col("id").alias("dst"), F.col("vid").alias("t")), "dst").select("s", "t", "weight"))
    return accounts, arcs


def risk_walk(e: DataFrame, risky: DataFrame, weight: str = "transaction_count", damping: float = 0.85, tolerance: float = 1e-10,
              max_rounds: int = 200) -> DataFrame:
    """`id, risk`: how often a walk along payments is at an account, if it begins at the accounts in `risky(id)`.

    A personalised PageRank. From an account the walk follows a payment in proportion to `weight`, or with probability 1 - `damping`, and
    always where nothing is paid on, goes back to a risky account, each as likely. All shares add up to 1. Power iteration
    on stored rounds ends when a round moves less than `tolerance` in all; each round shrinks that by `damping`. Without a risky
    account in the graph all risks are 0.

    An account that nobody pays is only reached by going back: its risk is its seed times a number that all such accounts share. So what they pay on
    is summed once, and rounds only run over payments of accounts that are paid themselves; what other accounts get follows from two numbers a round.
    """
    whole = F.col("src").isNotNull() & F.col("dst").isNotNull()
    known = e.select("src", "dst", F.when(whole, F.col(weight).cast("double")).alias("weight"), whole.alias("whole"))
    ends = known.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.col("weight").alias("out"), F.lit(False).alias("is_paid")),
        F.struct(F.col("dst").alias("id"), F.lit(None).cast("double").alias("out"), F.col("whole").alias("is_paid")))))
    accounts = stored(
        ends.groupBy("id").agg(F.coalesce(F.sum("out"), F.lit(0.0)).alias("paid"), F.max("is_paid").alias("is_paid"))
        .join(risky.select("id", F.lit(True).alias("risky")).distinct(), "id", "left").withColumn("risky", F.coalesce("risky", F.lit(False))), "accounts")
    seeded = accounts.filter("risky").count()
    if not seeded:
        return accounts.select("id", F.lit(0.0).alias("risk"))
    seed = F.lit(1.0 / seeded)
    speaking = accounts.filter("paid > 0 AND (is_paid OR risky)").select(F.col("id").alias("src"), "paid", "is_paid")
    shares = stored(
        known.filter("whole").join(speaking, "src").select("src", "dst", (F.col("weight") / F.col("paid")).alias("share"), "is_paid"), "shares")
    inner = shares.filter("is_paid")
    nothing, no = F.lit(0.0), F.lit(False)
    parts = [
        accounts.filter("risky").select("id", seed.alias("seed"), nothing.alias("got"), (F.col("paid") > 0).alias("passes_on"), no.alias("inner")),
        shares.filter("NOT is_paid").groupBy(F.col("dst").alias("id")).agg(F.sum(seed * F.col("share")).alias("got"))
        .select("id", nothing.alias("seed"), "got", no.alias("passes_on"), no.alias("inner")),
        inner.select(F.col("src").alias("id"), nothing.alias("seed"), nothing.alias("got"), F.lit(True).alias("passes_on"), F.lit(True).alias("inner")),
        inner.select(F.col("dst").alias("id"), nothing.alias("seed"), nothing.alias("got"), no.alias("passes_on"), F.lit(True).alias("inner")),
    ]
    reached = reduce(DataFrame.unionByName, parts).groupBy("id").agg(
        F.sum("seed").alias("seed"), F.coalesce(F.sum("got"), nothing).alias("got"), F.max("passes_on").alias("passes_on"), F.max("inner").alias("inner"))
    reached = stored(reached.withColumn("vid", F.monotonically_increasing_id()), "reached")
    still, numbers = reached.filter("NOT inner").select("seed", "got", "passes_on"), reached.filter("inner").select("id", "vid")
    arcs = stored(
        inner.join(numbers.select(F.col("id").alias("src"), F.col("vid").alias("s")), "src")
        .join(numbers.select(F.col("id").alias("dst"), F.col("vid").alias("t")), "dst").select("s", "t", "share"), "arcs")
    seeds, got, passing = still.agg(*[F.coalesce(F.sum(c), nothing) for c in (F.col("seed"), F.col("got"), F.when(F.col("passes_on"), F.col("seed")))]).first()

    def apart(of_seed: float, of_got: float) -> float:
        """How much the accounts outside the rounds have moved."""
        if of_seed * of_got >= 0:
            return abs(of_seed) * seeds + abs(of_got) * got
        return still.agg(F.coalesce(F.sum(F.abs(F.col("seed") * of_seed + F.col("got") * of_got)), nothing)).first()[0]

    now = stored(reached.filter("inner").select("vid", "seed", "got", "passes_on", F.col("seed").alias("risk"), F.lit(1.0).alias("step")), "risk")
    # A seed's risk outside the rounds is its seed times `back`; one of the round before has paid `got` times `before`.
    back, before, moved_apart = 1.0, 0.0, float(reached.filter("NOT inner").count())
    for _ in range(max_rounds):
        passed, moved = now.agg(F.coalesce(F.sum(F.when(F.col("passes_on"), F.col("risk"))), nothing), F.coalesce(F.sum("step"), nothing)).first()
        if moved + moved_apart < tolerance:
            risks = reached.join(now.select("vid", "risk"), "vid", "left").select(
                "id", F.coalesce("risk", F.col("seed") * back + F.col("got") * (damping * before)).alias("risk"))
            return accounts.select("id").join(risks, "id", "left").select("id", F.coalesce("risk", nothing).alias("risk"))
        come = (
            arcs.join(now.select(F.col("vid").alias("s"), "risk").filter("risk > 0"), "s").groupBy(F.col("t").alias("vid"))
            .agg(F.sum(F.col("risk") * F.col("share")).alias("come"))
        )
        # What does not move along a payment goes back to the seeds.
        again = 1 - damping * (passed + passing * back)
        risk = F.col("seed") * again + (F.coalesce("come", nothing) + F.col("got") * back) * damping
        now = stored(now.join(come, "vid", "left").select("vid", "seed", "got", "passes_on", risk.alias("risk"), F.abs(risk - F.col("risk")).alias("step")), "risk")
        moved_apart = apart(again - back, damping * (back - before))
        back, before = again, back
    raise NotConverged(f"risk did not settle within {max_rounds} rounds")


def communities(e: DataFrame, weight: str = "transaction_count", rounds: int = 10) -> DataFrame:
    """`id, community` after `rounds` of label propagation, or as many as change anything.

    All accounts at once take the label that weighs most among their neighbours, payments either way, and themselves, with the
    weight of their heaviest neighbour; of equally heavy ones the smallest. A community is named after the account whose label it bears.
    A hub's neighbours are summed by label before they meet.

    An account with a single neighbour hears that one's label as loud as its own, so it bears the smallest of its own number and all labels
    the neighbour has had. Rounds keep that smallest label with the neighbour, and labels of the other accounts alone.
    """
    accounts, arcs = _numbered(e, weight)
    pairs = stored(_pairs(arcs), "pairs")
    ends = pairs.select("weight", F.explode(F.array("a", "b")).alias("vid"))
    own = stored(ends.groupBy("vid").agg(F.max("weight").alias("own"), F.count(F.lit(1)).alias("n")), "own")
    counts = own.select("vid", (F.col("n") == 1).alias("single"))
    sided = stored(
        pairs.join(counts.withColumnsRenamed({"vid": "a", "single": "single_a"}), "a").join(counts.withColumnsRenamed({"vid": "b", "single": "single_b"}), "b"), "sided")
    # Of two accounts that only know one another, neither is followed through the other.
    leaf_a, leaf_b = F.col("single_a") & ~F.col("single_b"), F.col("single_b") & ~F.col("single_a")
    leaves = sided.filter(leaf_a | leaf_b).select(
        F.when(leaf_a, F.col("b")).otherwise(F.col("a")).alias("v"), F.when(leaf_a, F.col("a")).otherwise(F.col("b")).alias("leaf"), "weight")
    inner = sided.filter(~(leaf_a | leaf_b))
    ties = stored(_both_ways(inner.select("a", "b", "weight")), "ties")
    followed = own.filter("n > 1").select("vid", "own").unionByName(
        inner.filter("single_a").select("weight", F.explode(F.array("a", "b")).alias("vid")).select("vid", F.col("weight").alias("own")))
    # No leaf has heard anything yet: numbers are smaller than this.
    labels = stored(followed.select("vid", "own", F.col("vid").alias("label"), F.lit((1 << 63) - 1).alias("least")), "labels")
    leaf_label = F.least("leaf", "least").alias("label")
    for _ in range(rounds):
        heard = ties.join(labels.select(F.col("vid").alias("other"), "label"), "other").select("v", "label", "weight")
        told = leaves.join(labels.select(F.col("vid").alias("v"), "least"), "v").select("v", leaf_label, "weight")
        kept = labels.select(F.col("vid").alias("v"), "label", F.col("own").alias("weight"))
        by_label = heard.unionByName(told).unionByName(kept).groupBy("v", "label").agg(F.sum("weight").alias("weight"))
        chosen = stored(by_label.groupBy("v").agg(F.max(F.struct("weight", (-F.col("label")).alias("low"))).alias("best"))
                        .select(F.col("v").alias("vid"), (-F.col("best.low")).alias("new")), "chosen")
        least = F.least("least", "label")
        labels = stored(
            labels.join(chosen, "vid").select(
                "vid", "own", F.col("new").alias("label"), least.alias("least"), ((F.col("new") != F.col("label")) | (least != F.col("least"))).alias("moved")), "labels")
        if labels.filter("moved").isEmpty():
            break
        labels = labels.drop("moved")
    heads = accounts.select(F.col("vid").alias("label"), F.col("id").alias("community"))
    final = labels.select("vid", "label").unionByName(
        leaves.join(labels.select(F.col("vid").alias("v"), "least"), "v").select(F.col("leaf").alias("vid"), leaf_label))
    named = accounts.join(final, "vid", "left").select("id", F.coalesce("label", "vid").alias("label"))
    return named.join(heads, "label").select("id", "community")


def _pairs(arcs: DataFrame) -> DataFrame:
    """`a, b, weight` with a < b, payments in either direction added up, loops left out."""
    low, high = F.least("s", "t"), F.greatest("s", "t")
    return arcs.filter("s != t").groupBy(low.alias("a"), high.alias("b")).agg(F.sum("weight").alias("weight"))


def _both_ways(pairs: DataFrame) -> DataFrame:
    """`v, other, weight` for either end."""
    return pairs.select("weight", F.inline(F.array(
        F.struct(F.col("a").alias("v"), F.col("b").alias("other")), F.struct(F.col("b").alias("v"), F.col("a").alias("other"))))).select("v", "other", "weight")


def modularity(e: DataFrame, found: DataFrame, weight: str = "transaction_count") -> DataFrame:
    """One row, `communities, modularity`: how much more weight lies within the communities of `found(id, community)` than by chance.

    Directions don't count, and loops are left out. Null without a weight.
    """
    def of(end: str) -> DataFrame:
        return found.select(F.col("id").alias(end), F.col("community").alias(f"{end}_of"))

    loopless = e.filter(F.col("src") != F.col("dst")).select("src", "dst", F.col(weight).cast("double").alias("weight"))
    ends = loopless.join(of("src"), "src").join(of("dst"), "dst").select(F.col("weight"), F.inline(F.array(
        F.struct(F.col("src_of").alias("community"), (F.col("src_of") == F.col("dst_of")).alias("within")),
        F.struct(F.col("dst_of").alias("community"), (F.col("src_of") == F.col("dst_of")).alias("within")))))
    per = found.select("community").distinct().join(
        ends.groupBy("community").agg(F.sum("weight").alias("ends"), F.sum(F.when(F.col("within"), F.col("weight")).otherwise(0.0)).alias("inner")),
        "community", "left")
    total = F.sum("ends")
    share: Column = F.try_divide(F.sum("inner"), total) - F.try_divide(F.sum(F.col("ends") * F.col("ends")), total * total)
    return per.agg(F.count(F.lit(1)).alias("communities"), share.alias("modularity"))
