"""Scaled copies and labelled ring patterns, drawn reproducibly on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.clock import jitter, shift_days
from ledgerweb.functions.draws import integer_between, uniform, uniform_between
from ledgerweb.functions.lineage import cut
from ledgerweb.operators.graph import account_pool

# Fixed values of the ring pattern.
BASE_TIME = "2024-01-01 00:00:00"
RING_AMOUNT = (500.0, 10_000.0)
NOISE_AMOUNT = (100.0, 5_000.0)
JITTER_SECONDS = 3600


def row_key(*extra: Column) -> list[Column]:
    """Text that identifies a cleaned transaction, the same in any engine."""
    return [
        F.col("sender"), F.col("receiver"), F.col("amount").cast("decimal(18,4)"), F.unix_micros("ts"), *extra
    ]


def scale(tx: DataFrame, copies: int = 10, noise: float = 0.1, salt: str = "scale") -> DataFrame:
    """`copies` time-shifted copies with amounts off by up to half of `noise` either way.

    One scan feeds all copies. A date column is derived anew after the shift.
    """
    copied = tx.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    factor = 1 + (uniform(salt, *row_key(F.col("copy"))) - 0.5) * noise
    shifted = copied.withColumns({"amount": F.col("amount") * factor, "ts": shift_days("ts", F.col("copy"))})
    if "transaction_date" in tx.columns:
        shifted = shifted.withColumn("transaction_date", F.to_date("ts"))
    return shifted.drop("copy")


def ring_rows(
    tx: DataFrame,
    n_rings: int = 30,
    size: tuple[int, int] = (5, 10),
    rewire: float = 0.6,
    noise: tuple[int, int] = (5, 8),
    salt: str = "ring",
) -> DataFrame:
    """Labelled ring payments and unlabelled noise around them.

    `ring, kind, step, sender, receiver, amount, ts, is_fraud, rewired`. The pool is all accounts in
    the order of a hash, so a run of neighbouring places is a random draw without replacement; a
    ring takes one such run. Step i pays step i + 1, the last one the first, unless the step is
    rewired to a random account.
    """
    pool = cut(account_pool(tx, salt))
    members = pool.agg(F.count(F.lit(1)).alias("n")).scalar()
    spark = tx.sparkSession

    def place(u: Column) -> Column:
        return F.floor(u * F.col("members")).cast("bigint")

    rings = spark.range(n_rings).select(
        F.col("id").alias("ring"),
        members.alias("members"),
        F.least(integer_between(*size, salt, F.lit("size"), "id"), members).cast("int").alias("ring_size"),
        integer_between(*noise, salt, F.lit("noise"), "id").alias("noise_rows"),
        F.floor(uniform(salt, F.lit("base"), "id") * members).cast("bigint").alias("base"),
    ).filter("members > 0")

    i = F.col("step").cast("bigint")
    steps = rings.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("ring_size") - 1))).withColumn(
        "rewired", uniform(salt, F.lit("rewire"), "ring", "step") < rewire
    )
    ring_part = steps.select(
        "ring", F.lit("ring").alias("kind"), "step",
        ((F.col("base") + i) % F.col("members")).alias("from_place"),
        F.when(F.col("rewired"), place(uniform(salt, F.lit("to"), "ring", "step")))
        .otherwise((F.col("base") + (i + 1) % F.col("ring_size")) % F.col("members")).alias("to_place"),
        uniform_between(*RING_AMOUNT, salt, F.lit("amount"), "ring", "step").alias("amount"),
        F.lit(1).alias("is_fraud"), "rewired",
    )
    noisy = rings.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("noise_rows") - 1)))
    noise_part = noisy.select(
        "ring", F.lit("noise").alias("kind"), "step",
        ((F.col("base") + F.floor(uniform(salt, F.lit("member"), "ring", "step") * F.col("ring_size")))
         % F.col("members")).alias("from_place"),
        place(uniform(salt, F.lit("noise_to"), "ring", "step")).alias("to_place"),
        uniform_between(*NOISE_AMOUNT, salt, F.lit("noise_amount"), "ring", "step").alias("amount"),
        F.lit(0).alias("is_fraud"), F.lit(False).alias("rewired"),
    )
    drawn = ring_part.unionByName(noise_part).withColumn(
        "ts", jitter(F.lit(BASE_TIME).cast("timestamp"), JITTER_SECONDS, salt, F.lit("ts"), "kind", "ring", "step")
    )
    senders = pool.select(F.col("place").alias("from_place"), F.col("id").alias("sender"))
    receivers = pool.select(F.col("place").alias("to_place"), F.col("id").alias("receiver"))
    return drawn.join(senders, "from_place").join(receivers, "to_place").select(
        "ring", "kind", "step", "sender", "receiver", "amount", "ts", "is_fraud", "rewired"
    )


def append_rings(tx: DataFrame, rows: DataFrame) -> DataFrame:
    """Base rows plus drawn rows, by name, under the five columns the training table has."""
    columns = ["sender", "receiver", "amount", "ts", "is_fraud"]
    return tx.select(*columns).unionByName(rows.select(*columns))


def inject_rings(tx: DataFrame, **options) -> DataFrame:
    return append_rings(tx, ring_rows(tx, **options))
