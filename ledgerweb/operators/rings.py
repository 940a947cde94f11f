"""Rings: simple directed cycles of payments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.functions.amounts import MONEY, money
from ledgerweb.functions.lineage import cut, stored
from ledgerweb.operators.graph import index_links
from ledgerweb.operators.strong import inner_arcs, strong_index

TRIM_ROUNDS = 6


def trim(arcs: DataFrame, rounds: int = TRIM_ROUNDS) -> DataFrame:
    """Drop edges that cannot lie on a cycle: a payer nobody pays, or a payee who never pays.

    This only makes the search smaller, so it stops as soon as a round drops nothing.
    """
    before = arcs.count()
    for _ in range(rounds):
        paid = arcs.select(F.col("dst").alias("src")).distinct()
        paying = arcs.select(F.col("src").alias("dst")).distinct()
        arcs = cut(arcs.join(paid, "src", "left_semi").join(paying, "dst", "left_semi"))
        after = arcs.count()
        if after == before or after == 0:
            break
        before = after
    return arcs


def _numbered(e: DataFrame) -> DataFrame:
    """Arcs `s, t, src, dst` with both ends numbered by neighbour count, trimmed to those that can lie on a cycle."""
    arcs = trim(cut(e.filter(F.col("src") != F.col("dst")).select("src", "dst")))
    numbers = index_links(arcs).accounts
    return stored(
        arcs.join(numbers.select(F.col("id").alias("src"), F.col("vid").alias("s")), "src")
        .join(numbers.select(F.col("id").alias("dst"), F.col("vid").alias("t")), "dst")
        .select("s", "t", "src", "dst"), "arcs")


def cycles(e: DataFrame, lengths: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    """`length, members, ring`: every simple directed cycle of 3 to 5 accounts once, its smallest id first.

    A cycle is named after its account with the most neighbours, called the top. It is put together from half paths of
    two steps that leave the top or come back to it over lower accounts; there are at most links^1.5 of them.
    Halves that end in one account close a cycle of four. For five, the pairs of ends are first reduced to
    the different ones that an arc joins, so no path of three steps is listed that doesn't close.
    """
    if not set(lengths) <= {3, 4, 5}:
        raise ValueError("rings of 3 to 5 accounts are found")
    arcs = _numbered(e)
    down = arcs.filter("t < s").select(F.col("s").alias("top"), F.col("t").alias("a"), F.col("src").alias("top_id"), F.col("dst").alias("a_id"))
    up = arcs.filter("s < t").select(F.col("t").alias("top"), F.col("s").alias("d"), F.col("src").alias("d_id"))
    leaving = stored(
        down.join(arcs.select(F.col("s").alias("a"), F.col("t").alias("b"), F.col("dst").alias("b_id")), "a").filter("b < top"), "leaving")
    found = []
    if 3 in lengths:
        back = up.select("top", F.col("d").alias("b"))
        found.append(leaving.join(back, ["top", "b"], "left_semi").select(F.array("top_id", "a_id", "b_id").alias("members")))
    if {4, 5} & set(lengths):
        coming = stored(
            up.join(arcs.select(F.col("t").alias("d"), F.col("s").alias("c"), F.col("src").alias("c_id")), "d").filter("c < top"), "coming")
        if 4 in lengths:
            closed = leaving.join(coming.withColumnRenamed("c", "b"), ["top", "b"]).filter("a != d")
            found.append(closed.select(F.array("top_id", "a_id", "b_id", "d_id").alias("members")))
        if 5 in lengths:
            joins = (
                leaving.select("top", "b").distinct().join(arcs.select(F.col("s").alias("b"), F.col("t").alias("c")), "b")
                .filter("c < top").join(coming.select("top", "c").distinct(), ["top", "c"], "left_semi")
            )
            open_ = stored(leaving.join(stored(joins, "joins"), ["top", "b"]).filter("a != c"), "open")
            closed = open_.join(coming, ["top", "c"]).filter("a != d AND b != d")
            found.append(closed.select(F.array("top_id", "a_id", "b_id", "c_id", "d_id").alias("members")))
    return _turned(reduce(DataFrame.unionAll, found))


def _turned(found: DataFrame) -> DataFrame:
    """`length, members, ring` of the rings in `found(members)`, turned so that the smallest id comes first."""
    return found.select(F.size("members").alias("length"), _smallest_first("members").alias("members"), _name("members").alias("ring"))


def _smallest_first(members: str) -> Column:
    first = F.array_position(members, F.array_min(members)).cast("int")
    return F.concat(F.slice(members, first, F.size(members)), F.slice(members, F.lit(1), first - 1))


def _name(members: str) -> Column:
    return F.concat_ws(">", _smallest_first(members))


def long_cycles(e: DataFrame, lengths: tuple[int, ...] = (6, 7, 8, 9, 10)) -> DataFrame:
    """`length, members, ring`: every simple directed cycle of the given lengths, 3 or more, once, its smallest id first.

    Only arcs within strongly connected components are walked. A cycle is put together at its account with the most neighbours, the
    top, from a path that leaves it over lower accounts and one that comes back to it; the first has half the cycle's steps, rounded
    up, the second the rest, and both end in the same account. So no path is listed that is longer than half a cycle, and of the longest
    ones only those that end where one of the others does. The paths are as many as the graph has: this is for
    graphs, or parts of graphs, in which an account pays few others.
    """
    if not lengths or min(lengths) < 3:
        raise ValueError("rings of 3 accounts and more are found")
    index = strong_index(e)
    arcs = stored(inner_arcs(index), "inner-arcs")
    out = {1: stored(arcs.filter("t < s").select(F.col("s").alias("top"), F.col("t").alias("b"), F.array("s", "t").alias("out")), "out")}
    back = {1: stored(arcs.filter("s < t").select(F.col("t").alias("top"), F.col("s").alias("b"), F.array().cast("array<bigint>").alias("back")), "back")}
    for i in range(2, max(n // 2 for n in lengths) + 1):
        steps = arcs.select(F.col("t").alias("b"), F.col("s").alias("c"))
        fresh = (F.col("c") < F.col("top")) & ~F.array_contains("back", F.col("c"))
        longer = back[i - 1].join(steps, "b").filter(fresh)
        back[i] = stored(longer.select("top", F.col("c").alias("b"), F.concat(F.array("b"), F.col("back")).alias("back")), "back")
    for i in range(2, max((n + 1) // 2 for n in lengths) + 1):
        steps = arcs.select(F.col("s").alias("b"), F.col("t").alias("c"))
        fresh = (F.col("c") < F.col("top")) & ~F.array_contains("out", F.col("c"))
        longer = out[i - 1].join(steps, "b").filter(fresh).select("top", F.col("c").alias("b"), F.concat("out", F.array("c")).alias("out"))
        if 2 * i > max(lengths) - 1:  # of the longest paths only the ones that can be closed
            ends = back[max(lengths) // 2].select("top", "b").distinct()
            if 2 * i - 1 in lengths and 2 * i in lengths:
                ends = ends.unionByName(back[i - 1].select("top", "b")).distinct()
            longer = longer.join(ends, ["top", "b"], "left_semi")
        out[i] = stored(longer, "out")
    found = [
        out[(n + 1) // 2].join(back[n // 2], ["top", "b"]).filter(~F.arrays_overlap("out", "back")).select(F.concat("out", "back").alias("ring"))
        for n in sorted(set(lengths))
    ]
    numbered = stored(reduce(DataFrame.unionAll, found).select(F.monotonically_increasing_id().alias("nth"), "ring"), "rings")
    # Numbers become ids again; a ring has a bounded number of members.
    named = numbered.select("nth", F.posexplode("ring").alias("place", "vid")).join(index.accounts, "vid")
    whole = named.groupBy("nth").agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("members"))
    return _turned(whole.select(F.col("members.id").alias("members")))


def by_account(found: DataFrame) -> DataFrame:
    """`id, length, rings`: how many of the found rings of each length an account belongs to."""
    return found.select(F.explode("members").alias("id"), "length").groupBy("id", "length").agg(F.count(F.lit(1)).alias("rings"))


def timed_rings(tx: DataFrame, lengths: tuple[int, ...] = (3, 4, 5), within_seconds: int = 3600, key: str = "seq") -> DataFrame:
    """Rings of single payments, each later than the one before and at most `within_seconds` after it.

    `length, ring, payments, first_ts, last_ts, amount` for every row of different accounts that pay one another in turn until the
    first one is paid; `payments` lists the `key` of each payment, which has to identify it. A ring is found once, as it begins
    with its earliest payment.

    Only payments between accounts that can lie on a cycle are walked. A step is a range join: payments lie in time slots of `within_seconds`, and one
    meets those of its payee in its own slot and the next, so that a pair of rows is only formed within two slots. The steps are found once and
    stored; paths are then joined on payments, the longest ones also on the account that closes the ring.
    """
    if not lengths or min(lengths) < 2:
        raise ValueError("rings of 2 accounts and more are found")
    micros = within_seconds * 1_000_000
    at = F.unix_micros("ts")
    timed = tx.filter("sender != receiver AND ts IS NOT NULL").select(
        F.col(key).alias("payment"), "sender", "receiver", at.alias("at"), money("amount").alias("amount"))
    arcs = trim(cut(timed.select(F.col("sender").alias("src"), F.col("receiver").alias("dst")).distinct()))
    paid = stored(timed.join(arcs.select(F.col("src").alias("sender"), F.col("dst").alias("receiver")), ["sender", "receiver"], "left_semi"), "payments")
    slot = F.floor(F.col("at") / micros).cast("bigint")
    before = paid.select(F.col("payment").alias("one"), F.col("receiver").alias("account"), F.col("at").alias("one_at"),
                         F.explode(F.array(slot, slot + 1)).alias("slot"))
    after = paid.select(F.col("payment").alias("next"), F.col("sender").alias("account"), F.col("receiver").alias("to"), F.col("at").alias("next_at"),
                        F.col("amount").alias("more"), slot.alias("slot"))
    steps = stored(
        before.join(after, ["account", "slot"]).filter((F.col("next_at") > F.col("one_at")) & (F.col("next_at") - F.col("one_at") <= micros))
        .select("one", "next", "to", "next_at", "more"), "steps")
    paths = paid.select(
        F.col("payment").alias("one"), F.array("sender", "receiver").alias("members"), F.array("payment").alias("payments"),
        F.col("at").alias("first_at"), F.col("at").alias("last_at"), "amount")
    found = []
    for length in range(2, max(lengths) + 1):
        last = length == max(lengths)
        walked = paths.join(steps, (paths["one"] == steps["one"]) & (paths["members"][0] == steps["to"]) if last else "one")
        closes = F.col("to") == F.col("members")[0]
        total = (F.col("amount") + F.col("more")).cast(MONEY).alias("amount")
        longer = [F.concat("payments", F.array("next")).alias("payments"), "first_at", F.col("next_at").alias("last_at"), total]
        if length in lengths:
            found.append(walked.filter(closes).select(F.lit(length).alias("length"), "members", *longer))
        if not last:
            paths = stored(
                walked.filter(~F.array_contains("members", F.col("to")))
                .select(F.col("next").alias("one"), F.concat("members", F.array("to")).alias("members"), *longer), "paths")
    return reduce(DataFrame.unionAll, found).select(
        "length", F.concat_ws(">", "members").alias("ring"), "payments", F.timestamp_micros("first_at").alias("first_ts"),
        F.timestamp_micros("last_at").alias("last_ts"), F.round(F.col("amount").cast("double"), 4).alias("amount"))


def ring_recall(drawn: DataFrame, e: DataFrame) -> DataFrame:
    """Of the drawn rings, how many are still whole and how many are cycles of the graph, looked up edge by edge.

    `ring_size, rings, whole, found`. Ring rows come from `augment.ring_rows`; a rewired ring is found if other
    payments close it.
    """
    steps = drawn.filter("kind = 'ring'").select("ring", "step", "sender", "rewired")
    # A ring has a bounded number of steps.
    in_ring = W.partitionBy("ring").orderBy("step")
    whole = in_ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    asked = steps.withColumn("next", F.coalesce(F.lead("sender").over(in_ring), F.first("sender").over(whole)))
    known = e.select(F.col("src").alias("sender"), F.col("dst").alias("next"), F.lit(True).alias("there")).distinct()
    per_ring = asked.join(known, ["sender", "next"], "left").groupBy("ring").agg(
        F.count(F.lit(1)).cast("int").alias("ring_size"), F.bool_or("rewired").alias("broken"),
        F.bool_and(F.coalesce("there", F.lit(False))).alias("found"))
    return per_ring.groupBy("ring_size").agg(
        F.count(F.lit(1)).alias("rings"), F.count_if(~F.col("broken")).alias("whole"), F.count_if("found").alias("found"))


def searched_recall(drawn: DataFrame, found: DataFrame) -> DataFrame:
    """As `ring_recall`, but by the rings that a search has found: `ring_size, rings, whole, found`.

    Drawn rings whose payments join their accounts in the drawn order are looked up by name among `found(ring)`.
    """
    steps = drawn.filter("kind = 'ring'").groupBy("ring").agg(
        F.sort_array(F.collect_list(F.struct("step", "sender"))).alias("steps"), F.bool_or("rewired").alias("broken"))
    named = stored(steps.select(F.col("ring").alias("nth"), "broken", F.col("steps.sender").alias("members")), "drawn")
    asked = named.select("nth", "broken", F.size("members").alias("ring_size"), _name("members").alias("ring"))
    known = found.select("ring").distinct().withColumn("there", F.lit(True))
    return asked.join(known, "ring", "left").groupBy("ring_size").agg(
        F.count(F.lit(1)).alias("rings"), F.count_if(~F.col("broken")).alias("whole"), F.count_if("there").alias("found"))
