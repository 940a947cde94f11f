"""Table contracts shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TRANSACTIONS = T.StructType([
    T.StructField("sender", T.StringType()),
    T.StructField("receiver", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("type", T.StringType()),
    T.StructField("is_fraud", T.IntegerType()),
])
CONTRACT = TRANSACTIONS.fieldNames()

# The simulator's export: `step` is an integer clock, `isFraud` is optional.
RAW_EXPORT = T.StructType([
    T.StructField("nameOrig", T.StringType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("step", T.LongType()),
    T.StructField("isFraud", T.IntegerType()),
])

# What a user uploads; `timestamp` and `type` may be missing.
UPLOAD = T.StructType([
    T.StructField("sender", T.StringType()),
    T.StructField("receiver", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("type", T.StringType()),
])
REQUIRED_UPLOAD_COLUMNS = ("sender", "receiver", "amount")

# The payment categories and the default one.
PAYMENT_TYPES = ("P2P", "P2M", "Recharge", "Bill Payment", "Other")
DEFAULT_TYPE = "P2P"
MIN_AMOUNT = 0.01

FEATURES = ["degree", "tx_count_in", "tx_count_out", "amount_in", "amount_out",
            "cluster_size", "triangle_count"]
ADDITIVE_FEATURES = FEATURES[:5]

# The three columns the reference forest is trained on.
MODEL_FEATURES = ["degree", "tx_count_in", "tx_count_out"]


@dataclass(frozen=True)
class ScoreConfig:
    """Thresholds and weights of the rule score and of its risk bands (fixed default values)."""

    tx_out: float = 5
    amount_out: float = 500_000
    amount_in: float = 1_000
    w_tx_out: float = 0.25
    w_amount_out: float = 0.25
    w_amount_in: float = 0.20
    w_no_triangle: float = 0.15
    w_isolated: float = 0.15
    fraud: float = 0.7
    suspect: float = 0.4


DEFAULT_SCORE = ScoreConfig()
