"""The driver's tables seen as payment tables. All rows of each table are used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweb.schema import ScoreConfig

COLUMNS = ["seq", "sender", "receiver", "amount", "ts", "type", "is_fraud"]

# Thresholds that split the accounts of `ledger`, whose amounts are far below the default ones.
LEDGER_SCORE = ScoreConfig(tx_out=65, amount_out=3300, amount_in=5000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as payments among accounts of one namespace: loops, reciprocal pairs, triangles."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("sender"),
        F.concat(F.lit("A"), F.get_json_object("props", "$.k")).alias("receiver"),
        F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("type"),
        ((F.col("event_type") == "error") & (F.col("value") >= 200)).cast("int").alias("is_fraud"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as payments of customers to suppliers: a bipartite graph."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("sender"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("receiver"),
        F.col("l_extendedprice").alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )


def remittances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments to their customers: one star component per customer."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("sender"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("receiver"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderpriority").alias("type"),
        ((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") >= 400000)).cast("int").alias("is_fraud"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers and remittances together: one dense component and many small ones."""
    return transfers(spark, sf_dir).unionByName(remittances(spark, sf_dir))


def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers under the column names of the simulator's export."""
    return transfers(spark, sf_dir).select(
        F.col("sender").alias("nameOrig"), F.col("receiver").alias("nameDest"), "amount",
        F.unix_timestamp("ts").alias("step"), F.col("is_fraud").alias("isFraud"),
    )


def with_copies_and_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers plus a second copy of the error rows and rows without a receiver."""
    t = transfers(spark, sf_dir)
    copies = t.filter("type = 'error'")
    gaps = t.filter("type = 'signup'").withColumn("receiver", F.lit(None).cast("string"))
    return t.unionByName(copies).unionByName(gaps)


def dirty_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers as an upload with blank, missing and out-of-range values."""
    t = transfers(spark, sf_dir)
    kind = (
        F.when(F.col("type") == "purchase", "P2M").when(F.col("type") == "signup", "P2P")
        .when(F.col("type") == "view", "Recharge").when(F.col("type") == "error", "Refund")
    )
    return t.select(
        F.when(F.col("receiver") == "A7", "  ").otherwise(F.col("sender")).alias("sender"),
        F.when(F.col("receiver") != "A8", F.col("receiver")).alias("receiver"),
        F.when(F.col("receiver") != "A9", F.col("amount") - 1).alias("amount"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        kind.alias("type"),
    )


def broken_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers as the lines of a CSV file under its header: those to A8 end early, those to A9 have a field too many."""
    t = transfers(spark, sf_dir)
    fields = F.concat_ws(",", "sender", "receiver", F.col("amount").cast("string"), F.lit("P2P"))
    line = F.when(F.col("receiver") == "A8", F.concat_ws(",", "sender", "receiver")).when(F.col("receiver") == "A9", F.concat_ws(",", fields, F.lit("x")))
    return t.select(F.coalesce(line, fields).alias("sender,receiver,amount,type"))
