"""The batch pipeline as stored tables: bronze, silver, scaled, final, edges, nodes, features, predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerweb.functions.lineage import cut
from ledgerweb.operators import augment, features, graph, ingest, model
from ledgerweb.schema import MODEL_FEATURES
from ledgerweb.sources.writers import write_table

TABLES = ("transactions_bronze", "transactions_silver", "transactions_scaled", "transactions_final",
          "nodes_table", "edges_table", "ml_features", "labelled_features", "fraud_predictions")


def run(
    spark: SparkSession, raw: DataFrame, root: str, copies: int = 10, mode: str = "true",
    columns: list[str] = MODEL_FEATURES, rings: dict | None = None, fmt: str = "parquet",
) -> dict[str, str]:
    """Raw export → every table of the pipeline under `root`; returns their paths.

    Each stage reads what the stage before has stored, so a lost job resumes at a table.
    """
    paths = {name: f"{root}/{name}" for name in TABLES}

    def store(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        write_table(df, paths[name], fmt, partition_by)
        return spark.read.format(fmt).load(paths[name])

    bronze = store(ingest.to_contract(raw), "transactions_bronze")
    silver = store(ingest.clean(bronze), "transactions_silver", ["transaction_date"])
    scaled = store(augment.scale(silver, copies), "transactions_scaled", ["transaction_date"])
    final = store(augment.inject_rings(scaled, **(rings or {})), "transactions_final")
    edges = store(graph.edges(final), "edges_table")
    store(graph.nodes(edges), "nodes_table")
    table = store(features.from_edges(edges, mode), "ml_features")
    labelled = store(features.with_labels(table, features.labels(final)), "labelled_features")
    # The class ratio is that of all labelled accounts, not of the training ones.
    training, test = model.split(model.with_class_weight(labelled))
    fitted = model.train(training, columns)
    predictions = cut(model.predict(fitted, test))
    store(model.prediction_table(predictions), "fraud_predictions")
    metrics = {"pr_auc": model.evaluator_pr_auc(predictions)}
    model.save_run(fitted, metrics, f"{root}/run", training)
    return paths
