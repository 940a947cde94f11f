"""Raw rows → the transaction contract, cleaned and validated."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweb.functions import clock
from ledgerweb.schema import DEFAULT_TYPE, MIN_AMOUNT, PAYMENT_TYPES
from ledgerweb.sources import readers

KEYS = ["sender", "receiver", "amount", "ts"]


def to_contract(
    raw: DataFrame,
    mapping: Mapping[str, str] = readers.EXPORT_MAPPING,
    step: str = "step",
    unit_seconds: int = 1,
    label: str = "isFraud",
    type_column: str = "type",
) -> DataFrame:
    """Rename and type an export. The label is kept; without one every row gets 0."""
    readers.require_columns(raw, [*mapping.values(), step])
    has_label, has_type = label in raw.columns, type_column in raw.columns
    return raw.select(
        F.col(mapping["sender"]).cast("string").alias("sender"),
        F.col(mapping["receiver"]).cast("string").alias("receiver"),
        F.col(mapping["amount"]).cast("double").alias("amount"),
        clock.from_step(step, unit_seconds).alias("ts"),
        (F.col(type_column) if has_type else F.lit(None)).cast("string").alias("type"),
        (F.col(label) if has_label else F.lit(0)).cast("int").alias("is_fraud"),
    )


def read_transactions(spark: SparkSession, path: str, schema=None, infer: bool = False, **kwargs) -> DataFrame:
    """CSV export → contract (the Bronze step)."""
    from ledgerweb.schema import RAW_EXPORT

    return to_contract(readers.read_csv(spark, path, None if infer else schema or RAW_EXPORT, infer), **kwargs)


def coerce_upload(df: DataFrame, now_if_missing: bool = False, line: str | None = None) -> DataFrame:
    """Uploaded rows → contract: text ids, numeric amount, type P2P and time NULL by default.

    A row whose amount does not parse keeps a NULL amount, which `validate` reports. `line` names a column that is
    kept, in which the reader left the text of lines that don't fit.
    """
    readers.require_columns(df)
    ts = F.col("timestamp").try_cast("timestamp") if "timestamp" in df.columns else F.lit(None).cast("timestamp")
    if now_if_missing:
        ts = F.coalesce(ts, F.current_timestamp())
    kind = F.col("type").cast("string") if "type" in df.columns else F.lit(None).cast("string")
    label = F.col("is_fraud").try_cast("int") if "is_fraud" in df.columns else F.lit(0)
    return df.select(
        F.col("sender").cast("string").alias("sender"),
        F.col("receiver").cast("string").alias("receiver"),
        F.col("amount").try_cast("double").alias("amount"),
        ts.alias("ts"),
        F.coalesce(kind, F.lit(DEFAULT_TYPE)).alias("type"),
        F.coalesce(label, F.lit(0)).alias("is_fraud"),
        *([F.col(line)] if line else []),
    )


def clean(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL key and exact copies, then derive the date (the Silver step)."""
    return df.dropna(subset=KEYS).dropDuplicates().withColumn("transaction_date", F.to_date("ts"))


def rejection_reason(check_type: bool = True, line: str | None = None):
    """Why a row is not a payment; NULL for a valid one. A row of a line that doesn't fit is rejected for that, whatever it seems to hold."""
    def blank(name):
        return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""

    reason = (
        F.when(blank("sender"), "sender missing")
        .when(blank("receiver"), "receiver missing")
        .when(F.col("amount").isNull() | F.isnan("amount"), "amount missing")
        .when(F.col("amount") < MIN_AMOUNT, "amount below minimum")
    )
    if check_type:
        known = F.col("type").isin(*PAYMENT_TYPES)
        reason = reason.when(~F.coalesce(known, F.lit(False)), "unknown type")
    return F.when(F.col(line).isNotNull(), "broken line").otherwise(reason) if line else reason


def validate(df: DataFrame, check_type: bool = True, line: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into valid rows and rejected rows with their `reason`."""
    marked = df.withColumn("reason", rejection_reason(check_type, line))
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")
