"""Time-based account signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.functions.amounts import money, money_sum
from ledgerweb.functions.lineage import stored
from ledgerweb.functions.ordered import prior_moments, running


def velocity(tx: DataFrame, seconds: int = 3600) -> DataFrame:
    """Per transaction: count and amount its sender paid within the last `seconds`, itself included.

    Rows are first reduced to one per sender and second. A window never reaches further back than
    one bucket of its own length, so each reduced row is also placed in the next bucket and the
    window runs per (sender, bucket): at most 2 * `seconds` rows, however active the sender.
    """
    second = F.unix_timestamp("ts")
    per_second = tx.groupBy("sender", second.alias("sec")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("amount")).alias("amt")
    )
    own = F.floor(F.col("sec") / seconds).cast("bigint")
    placed = per_second.withColumn("own", own).withColumn(
        "bucket", F.explode(F.array(F.col("own"), F.col("own") + 1))
    )
    w = W.partitionBy("sender", "bucket").orderBy("sec").rangeBetween(-seconds, 0)
    rolled = (
        placed.select(
            "sender", "sec", "own", "bucket",
            F.sum("n").over(w).alias("tx_count"), F.sum("amt").over(w).cast("double").alias("tx_amount"),
        )
        .filter("own = bucket")
        .select("sender", "sec", F.col("tx_count").alias("velocity_count"),
                F.round("tx_amount", 4).alias("velocity_amount"))
    )
    return tx.withColumn("sec", second).join(rolled, ["sender", "sec"]).drop("sec")


def amount_deviation(tx: DataFrame, order: str = "seq") -> DataFrame:
    """Per transaction: how far its amount lies from the sender's earlier ones, in deviations.

    `prior_count, prior_mean, prior_std, amount_z`; `amount_z` is NULL before two earlier
    transactions or where those were all alike. `order` breaks ties in time.
    """
    history = prior_moments(tx, ["sender"], [F.col("ts"), F.col(order)], "amount")
    # Alike is told from the smallest and largest amount, not from a deviation near 0.
    alike = F.col("low") == F.col("high")
    std = F.when(F.col("n") >= 2, F.when(alike, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))))
    mean = F.when(F.col("n") >= 1, F.when(alike, F.col("low")).otherwise(F.col("mean")))
    return history.withColumns({"_mean": mean, "_std": std}).select(
        *tx.columns, F.col("n").alias("prior_count"), F.col("_mean").alias("prior_mean"), F.col("_std").alias("prior_std"),
        F.when(F.col("_std") > 0, (F.col("amount") - F.col("_mean")) / F.col("_std")).alias("amount_z"),
    )


EPOCH = 32  # half-lives
LEAST_SPREAD = 1e-4  # of the range; much less can't be told from rounding


def decayed_deviation(tx: DataFrame, half_life_seconds: int = 86_400, order: str = "seq") -> DataFrame:
    """Per transaction: how far its amount lies from the sender's earlier ones, of which the older count less.

    `prior_weight, decayed_mean, decayed_std, decayed_z`. An earlier payment counts half after each half-life, and no longer once two
    whole epochs of 32 half-lives lie between: it would weigh less than 2**-64. `decayed_z` is NULL before two earlier payments that
    count, or where their deviation is under a ten-thousandth of their range (it is then given as 0). `order` breaks ties in time.

    Weights are taken from the start of an epoch, where they stay within what doubles hold, and are summed by a running total over range
    partitions, so a busy sender is cut. What the two epochs before leave enters as rows before the first one.
    """
    length = half_life_seconds * EPOCH * 1_000_000
    at = F.unix_micros("ts")
    epoch = F.floor(at / length).cast("bigint")
    # Amounts are summed as distances from the sender's mean: large ones that lie close together keep their digits.
    centres = stored(tx.groupBy("sender").agg(F.avg("amount").alias("_centre")), "centres")
    centred = tx.join(centres, tx["sender"].eqNullSafe(centres["sender"])).drop(centres["sender"])
    x, weight = F.col("amount") - F.col("_centre"), F.pow(F.lit(2.0), (at - epoch * length) / (half_life_seconds * 1_000_000))
    rows = stored(centred.select(
        *tx.columns, "_centre", epoch.alias("_epoch"), at.alias("_at"), weight.alias("_w"), (weight * x).alias("_wx"), (weight * x * x).alias("_wxx"),
        F.lit(1).cast("bigint").alias("_n"), F.col("amount").alias("_top"), (-F.col("amount")).alias("_bottom"), F.lit(True).alias("_real")), "weighted")
    sums = ["_w", "_wx", "_wxx", "_n"]
    left = rows.groupBy("sender", "_epoch").agg(*[F.sum(c).alias(c) for c in sums], F.max("_top").alias("_top"), F.max("_bottom").alias("_bottom"))
    carried = left.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("_on"))
    fade = F.pow(F.lit(2.0), -EPOCH * F.col("_on"))
    before = carried.select(
        "sender", (F.col("_epoch") + F.col("_on")).alias("_epoch"), F.col("_on").cast("bigint").alias("_at"),
        *[(F.col(c) * fade).alias(c) for c in sums[:3]], "_n", "_top", "_bottom", F.lit(False).alias("_real"))
    every = rows.unionByName(before, allowMissingColumns=True)
    seen = running(every, ["sender", "_epoch"], [F.col("_real"), F.col("_at"), F.col(order)],
                   sums={f"{c}_sum": F.col(c) for c in sums}, maxes={"_high": F.col("_top"), "_low": F.col("_bottom")})
    counted, alike = F.col("_n_sum") > 0, F.col("_high") == -F.col("_low")
    extent = F.col("_high") + F.col("_low")  # `_low` is the smallest amount with its sign turned
    offset = F.try_divide("_wx_sum", "_w_sum")
    spread = F.greatest(F.try_divide("_wxx_sum", "_w_sum") - offset * offset, F.lit(0.0))
    scale = F.pow(F.lit(2.0), -(F.col("_at") - F.col("_epoch") * length) / (half_life_seconds * 1_000_000))
    found = seen.filter("_real").withColumns({
        "_mean": F.when(counted, F.when(alike, F.col("_high")).otherwise(F.col("_centre") + offset)),
        "_std": F.when(F.col("_n_sum") >= 2, F.when(F.sqrt(spread) < LEAST_SPREAD * extent, F.lit(0.0)).when(alike, F.lit(0.0)).otherwise(F.sqrt(spread)))})
    return found.select(
        *tx.columns, (F.col("_w_sum") * scale).alias("prior_weight"), F.col("_mean").alias("decayed_mean"), F.col("_std").alias("decayed_std"),
        F.when(F.col("_std") > 0, (F.col("amount") - F.col("_mean")) / F.col("_std")).alias("decayed_z"))


def window_totals(tx: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Per sender and tumbling or sliding window: count and amount. Works on streams as well."""
    return (
        tx.groupBy("sender", F.window("ts", width, slide) if slide else F.window("ts", width))
        .agg(F.count(F.lit(1)).alias("tx_count"), money_sum("amount").alias("tx_amount"))
        .select("sender", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "tx_count", F.round("tx_amount", 4).alias("tx_amount"))
    )


def sessions(tx: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Per sender: bursts of transactions at most `gap_seconds` apart.

    Transactions are first reduced to one row per sender and gap-long slot, in which all lie at most a gap apart.
    What opens a session is then a running maximum over the slots of earlier ends, which is cut by range partitioning:
    no task holds the whole history of one sender.
    """
    seconds = F.unix_micros("ts")
    slots = (
        tx.groupBy("sender", F.floor(seconds / (gap_seconds * 1_000_000)).cast("bigint").alias("slot"))
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"),
             F.sum(money("amount")).alias("amt"))
    )
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    seen = running(slots, ["sender"], [F.col("slot")], maxes={"before": F.col("last")})
    opens = F.coalesce(F.col("first") > F.col("before") + gap, F.lit(True)).cast("bigint")
    numbered = running(seen.withColumn("opens", opens), ["sender"], [F.col("slot")], sums={"nth": F.col("opens")}, inclusive=True)
    return numbered.groupBy("sender", "nth").agg(
        F.min("first").alias("session_start"), (F.max("last") + gap).alias("session_end"),
        F.sum("n").alias("tx_count"), F.round(F.sum("amt").cast("double"), 4).alias("tx_amount"),
    ).drop("nth")
