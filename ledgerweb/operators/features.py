"""The seven account features and the account label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.jobs import at_once
from ledgerweb.functions.lineage import stored
from ledgerweb.operators import graph
from ledgerweb.operators.components import component_labels
from ledgerweb.operators.triangles import triangle_counts
from ledgerweb.schema import FEATURES


def from_edges(e: DataFrame, mode: str = "true") -> DataFrame:
    """`id` and the seven features.

    `mode="true"` computes component sizes and triangles. `mode="proxy"` gives the batch
    notebook's stand-ins, out-neighbours plus in-neighbours and the degree, which over collapsed
    edges are both the degree.
    """
    base = graph.additive_features(e)
    if mode == "proxy":
        return base.select("id", *FEATURES[:5], F.col("degree").alias("cluster_size"),
                           F.col("degree").alias("triangle_count"))
    if mode != "true":
        raise ValueError(f"unknown feature mode {mode!r}")
    index = graph.index_links(e)
    # Both need the links alone. The many short jobs of one leave room for the other's few long tasks.
    clusters, triangles = at_once(
        e.sparkSession,
        lambda: component_labels(e, index).select("id", "cluster_size"),
        lambda: stored(triangle_counts(e, index), "triangles"))
    joined = base.join(clusters, "id", "left").join(triangles, "id", "left")
    return joined.select(
        "id", *FEATURES[:5], "cluster_size", F.coalesce("triangle_count", F.lit(0)).cast("bigint").alias("triangle_count")
    )


def extract(tx: DataFrame, mode: str = "true") -> DataFrame:
    """Transactions → account features."""
    e = graph.edges(tx)
    return from_edges(stored(e, "edges") if mode == "true" else e, mode)


def labels(tx: DataFrame) -> DataFrame:
    """1 for an account with a fraudulent transaction on either side, else 0."""
    return (
        tx.select(F.explode(F.array("sender", "receiver")).alias("id"), "is_fraud")
        .groupBy("id").agg(F.coalesce(F.max("is_fraud"), F.lit(0)).alias("label"))
        .select("id", (F.col("label") > 0).cast("int").alias("label"))
    )


def with_labels(features: DataFrame, account_labels: DataFrame) -> DataFrame:
    """Features with their label, 0 where an account has none."""
    return features.join(account_labels, "id", "left").fillna(0, subset=["label"])
