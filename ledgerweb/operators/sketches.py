"""Distinct accounts from stored sketches, one a day, that are merged without reading payments again."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.amounts import money

SIGMAS = 3  # an estimate lies beyond three deviations about once in 400 times
LARGEST = 21


def size_for(within: float) -> int:
    """The logarithm of a HyperLogLog sketch's registers whose error of three deviations is `within`, as a share."""
    needed = math.ceil(math.log2((1.04 * SIGMAS / within) ** 2))
    if needed > LARGEST:
        raise ValueError(f"no sketch is as exact as {within}")
    return max(needed, 4)


def daily(tx: DataFrame, within: float = 0.01) -> DataFrame:
    """`day, tx_count, amount, senders, receivers, accounts`: a day's totals and the sketches of its distinct accounts.

    The table is kept and grows by a row a day; an added day needs that day's payments only. Payments without a
    time belong to the day null, null accounts to no sketch. Sketches of different `within` are not merged.
    """
    size = size_for(within)
    one_each = tx.select(
        F.to_date("ts").alias("day"), F.inline(F.array(
            F.struct(F.col("sender").alias("sender"), F.lit(None).cast("string").alias("receiver"), F.col("sender").alias("account"),
                     F.lit(1).alias("n"), money("amount").alias("amt")),
            F.struct(F.lit(None).cast("string").alias("sender"), F.col("receiver").alias("receiver"), F.col("receiver").alias("account"),
                     F.lit(0).alias("n"), F.lit(0).cast("decimal(24,8)").alias("amt")))))
    return one_each.groupBy("day").agg(
        F.sum("n").alias("tx_count"), F.sum("amt").alias("amount"), F.hll_sketch_agg("sender", size).alias("senders"),
        F.hll_sketch_agg("receiver", size).alias("receivers"), F.hll_sketch_agg("account", size).alias("accounts"))


def _totals() -> list[Column]:
    found = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("senders", "receivers", "accounts")]
    return [F.sum("tx_count").alias("tx_count"), F.round(F.sum("amount").cast("double"), 4).alias("amount"), *found]


def merged(days: DataFrame) -> DataFrame:
    """One row: payments, amount, and distinct senders, receivers and accounts of all days together."""
    return days.agg(*_totals())


def trailing(days: DataFrame, length: int = 7) -> DataFrame:
    """The same for each day that has payments, over it and the `length` - 1 days before."""
    reached = F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("later")
    spread = days.filter("day IS NOT NULL").select("*", reached).withColumn("until", F.date_add("day", F.col("later")))
    own = days.select(F.col("day").alias("until")).filter("until IS NOT NULL").distinct()
    return spread.join(own, "until", "left_semi").groupBy(F.col("until").alias("day")).agg(*_totals())
