"""The registered queries: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweb.functions import amounts, clock
from ledgerweb.functions.lineage import cut, scratch_path, stored
from ledgerweb.operators import (
    augment, components, cores, features, graph, influence, ingest, isolation, model, neighbors, reports, rings, scoring, sketches, strong, temporal, triangles,
)
from ledgerweb.plans import medallion, views
from ledgerweb.plans.views import LEDGER_SCORE
from ledgerweb.schema import ADDITIVE_FEATURES, FEATURES, MODEL_FEATURES, RAW_EXPORT, TRANSACTIONS
from ledgerweb.sources import readers, writers
from ledgerweb.streaming import live, replay

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
THRESHOLDS = [i / 10 for i in range(1, 10)]
PR_AUC_TOLERANCE = 1e-3  # MLlib puts the curve into 1000 bins where there are more scores
SLICES = 4
SKETCH_ERROR = 0.01
RISK_TOLERANCE = 1e-8
COMMUNITY_ROUNDS = 5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def text(*names: str) -> list:
    """Timestamps as text, so that no result depends on how a client shows them."""
    return [F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n) for n in names]


def ledger_scores(spark, d) -> DataFrame:
    return ledger_scores_of(views.ledger(spark, d))


def ledger_scores_of(tx: DataFrame) -> DataFrame:
    return scoring.score_batch(tx, lambda f: scoring.rule_score(f, LEDGER_SCORE), LEDGER_SCORE)


def labelled_ledger(spark, d) -> DataFrame:
    tx = views.ledger(spark, d)
    return features.with_labels(features.extract(tx, "proxy"), features.labels(tx))


# --- graph tables and the additive score -------------------------------------------------------

@query
def edge_agg(spark, d):
    return graph.edges(views.payments(spark, d)).withColumn("total_amount", F.round("total_amount", 4))


@query
def node_features_additive(spark, d):
    return graph.additive_features(graph.edges(views.payments(spark, d)))


@query
def risk_scores_additive(spark, d):
    return scoring.band(scoring.rule_score(graph.additive_features(graph.edges(views.payments(spark, d)))))


# --- ingest and cleaning -----------------------------------------------------------------------

@query
def bronze_transactions(spark, d):
    bronze = ingest.to_contract(views.raw_export(spark, d))
    return bronze.select("sender", "receiver", "amount", *text("ts"), "is_fraud")


@query
def silver_dedup(spark, d):
    silver = ingest.clean(views.with_copies_and_gaps(spark, d))
    return silver.select("seq", "sender", "receiver", "amount", *text("ts"),
                         F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date"))


@query
def validate_rejects(spark, d):
    _, rejected = ingest.validate(ingest.coerce_upload(views.dirty_upload(spark, d)))
    return rejected.select("sender", "receiver", F.round("amount", 4).alias("amount"), "type", "reason")


@query
def validated_transactions(spark, d):
    valid, _ = ingest.validate(ingest.coerce_upload(views.dirty_upload(spark, d)))
    return valid.select("sender", "receiver", F.round("amount", 4).alias("amount"), *text("ts"), "type")


@query
def csv_import(spark, d):
    path = scratch_path(spark, "export")
    writers.export_csv(views.raw_export(spark, d), path)
    read = ingest.read_transactions(spark, path, RAW_EXPORT)
    return read.select("sender", "receiver", "amount", *text("ts"), "is_fraud")


@query
def upload_import(spark, d):
    """An uploaded file that lacks both optional columns: checked, typed, and split into valid and rejected rows."""
    path = scratch_path(spark, "upload")
    writers.export_csv(views.dirty_upload(spark, d).select("amount", "receiver", "sender"), path)
    valid, rejected = ingest.validate(ingest.coerce_upload(readers.read_upload(spark, path)))
    both = valid.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)
    return both.select("sender", "receiver", F.round("amount", 4).alias("amount"), "type", "is_fraud", "reason")


@query
def table_profile(spark, d):
    return reports.table_profile({name: views.table(spark, d, name) for name in TABLES})


@query
def label_counts(spark, d):
    return reports.label_counts(views.ledger(spark, d))


@query
def time_parts(spark, d):
    t = views.transfers(spark, d)
    noon = clock.combine(F.to_date("ts"), F.lit("12:00:00"))
    return t.select(
        "seq", clock.iso("ts").alias("iso"), clock.wall_clock("ts").alias("clock"),
        F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day"),
        clock.iso(noon).alias("noon"), clock.iso(clock.shift_days("ts", F.lit(3))).alias("in_three_days"),
        amounts.rupees("amount").alias("amount_text"),
    )


# --- graph basics ------------------------------------------------------------------------------

@query
def nodes(spark, d):
    return graph.nodes(views.ledger(spark, d))


@query
def account_universe(spark, d):
    return graph.account_pool(views.ledger(spark, d))


@query
def degree(spark, d):
    return graph.degree(graph.edges(views.ledger(spark, d)))


@query
def hubs_gt_t(spark, d):
    return graph.hubs(graph.edges(views.ledger(spark, d)), 10)


@query
def neighbor_counts(spark, d):
    return graph.neighbor_counts(graph.edges(views.ledger(spark, d)))


@query
def undirected_edges(spark, d):
    return graph.undirected(graph.edges(views.ledger(spark, d)))


@query
def top_edges(spark, d):
    return graph.top_edges(graph.edges(views.transfers(spark, d)), 2000).withColumn(
        "total_amount", F.round("total_amount", 4))


@query
def top_hub_subgraph(spark, d):
    return graph.top_hub_subgraph(graph.edges(views.transfers(spark, d))).withColumn(
        "total_amount", F.round("total_amount", 4))


@query
def viz_nodes(spark, d):
    return graph.viz_nodes(graph.edges(views.ledger(spark, d)))


@query
def viz_edges(spark, d):
    return graph.viz_edges(graph.edges(views.transfers(spark, d)))


@query
def reciprocal_pairs(spark, d):
    return graph.reciprocal_pairs(graph.edges(views.transfers(spark, d)))


@query
def reciprocal_counts(spark, d):
    return graph.reciprocal_counts(graph.edges(views.transfers(spark, d)))


@query
def flow_imbalance(spark, d):
    f = features.extract(views.ledger(spark, d))
    return graph.flow_signals(f).select(
        "id", "amount_in", "amount_out", "out_in_ratio", "only_sends", "disproportionate",
        "isolated_cluster", "no_triangles")


# --- triangles, components, features, scores ---------------------------------------------------

@query
def triangle_count(spark, d):
    return triangles.triangle_counts(cut(graph.edges(views.ledger(spark, d))))


@query
def triangle_count_transfers(spark, d):
    return triangles.triangle_counts(cut(graph.edges(views.transfers(spark, d))))


@query
def component_sizes(spark, d):
    return components.component_labels(cut(graph.edges(views.ledger(spark, d))))


@query
def component_table(spark, d):
    return components.component_sizes(cut(graph.edges(views.ledger(spark, d))))


@query
def node_features_full(spark, d):
    return features.extract(views.ledger(spark, d))


@query
def node_features_proxy(spark, d):
    return features.extract(views.ledger(spark, d), "proxy")


@query
def risk_scores(spark, d):
    return ledger_scores(spark, d)


@query
def risk_scores_payments(spark, d):
    return scoring.score_batch(views.payments(spark, d))


@query
def jittered_scores(spark, d):
    f = features.extract(views.ledger(spark, d), "proxy").select("id", *ADDITIVE_FEATURES)
    return scoring.rule_score(f, LEDGER_SCORE, jitter=0.05).select("id", scoring.SCORE)


# --- labels and balance ------------------------------------------------------------------------

@query
def node_labels(spark, d):
    return features.labels(views.ledger(spark, d))


@query
def labelled_features(spark, d):
    return labelled_ledger(spark, d)


@query
def class_weights(spark, d):
    return model.with_class_weight(cut(features.labels(views.ledger(spark, d)))).withColumn(
        "weight", F.round("weight", 9))


@query
def train_test_split(spark, d):
    return model.with_split(features.labels(views.ledger(spark, d)))


@query
def class_distribution(spark, d):
    return reports.class_distribution(features.labels(views.ledger(spark, d)))


@query
def class_ratio(spark, d):
    return model.class_ratio(features.labels(views.ledger(spark, d))).withColumn("ratio", F.round("ratio", 9))


@query
def smote_rows(spark, d):
    made = model.smote(labelled_ledger(spark, d), ADDITIVE_FEATURES, per_row=2)
    return made.select("id", *[F.round(c, 4).alias(c) for c in ADDITIVE_FEATURES], "label")


@query
def nearest_fraud(spark, d):
    """The five nearest labelled accounts of every labelled account."""
    found = neighbors.nearest(labelled_ledger(spark, d).filter("label = 1"), ADDITIVE_FEATURES)
    return found.withColumn("distance", F.round("distance", 9))


@query
def smote_neighbor_rows(spark, d):
    made = neighbors.smote(labelled_ledger(spark, d), ADDITIVE_FEATURES, per_row=2)
    return made.select("id", *[F.round(c, 4).alias(c) for c in ADDITIVE_FEATURES], "label")


# --- reports -----------------------------------------------------------------------------------

@query
def feature_summary(spark, d):
    return reports.feature_summary(features.extract(views.ledger(spark, d)))


@query
def risk_bands(spark, d):
    return scoring.risk_bands(ledger_scores(spark, d), LEDGER_SCORE).withColumn(
        "share_text", amounts.percent("share"))


@query
def degree_hist(spark, d):
    return reports.degree_hist(graph.degree(graph.edges(views.ledger(spark, d))))


@query
def amount_log_hist(spark, d):
    return reports.log_hist(cut(graph.additive_features(graph.edges(views.payments(spark, d)))))


@query
def top_alerts(spark, d):
    return scoring.top_alerts(ledger_scores(spark, d), 10, LEDGER_SCORE)


@query
def accounts_by_risk(spark, d):
    return scoring.by_risk(ledger_scores(spark, d), ranked=True).select("rank", "id", scoring.SCORE, "label")


@query
def top_scored_per_band(spark, d):
    return scoring.alerts_per_group(ledger_scores(spark, d), "label", 8).select("label", "rank", "id", scoring.SCORE)


@query
def recent_transactions(spark, d):
    return reports.recent(views.transfers(spark, d), 20).select(
        "seq", "sender", "receiver", "amount", *text("ts"), "type")


@query
def session_totals(spark, d):
    return reports.session_totals(views.ledger(spark, d), ledger_scores(spark, d), LEDGER_SCORE)


@query
def accounts_sketch(spark, d):
    """Whether the sketch of the number of accounts comes as near to the exact one as asked for, over all and per payment type."""
    tx = views.ledger(spark, d)
    ends = tx.select("type", F.explode(F.array("sender", "receiver")).alias("id")).distinct()
    exact = ends.groupBy("type").agg(F.count(F.lit(1)).alias("exact")).unionByName(
        graph.nodes(tx).agg(F.count(F.lit(1)).alias("exact")).select(F.lit(None).cast("string").alias("type"), "exact"))
    sketched = reports.approximate_accounts(tx, SKETCH_ERROR, ["type"]).unionByName(
        reports.approximate_accounts(tx, SKETCH_ERROR).select(F.lit(None).cast("string").alias("type"), "accounts")).withColumnRenamed("type", "of")
    return exact.join(sketched, F.col("type").eqNullSafe(F.col("of"))).select(
        "type", "exact", (F.abs(F.col("accounts") / F.col("exact") - 1) <= SKETCH_ERROR).alias("is_close"))


@query
def daily_account_sketches(spark, d):
    """Stored daily sketches merged over seven days: exact numbers, and whether the merged ones are within the asked error of them."""
    tx = views.ledger(spark, d)
    path = scratch_path(spark, "sketches")
    sketches.daily(tx, SKETCH_ERROR).write.parquet(path)
    found = sketches.trailing(spark.read.parquet(path), 7)
    ends = tx.select(F.to_date("ts").alias("day"), F.explode(F.array("sender", "receiver")).alias("id")).distinct()
    until = ends.select("id", F.explode(F.sequence("day", F.date_add("day", 6))).alias("day"))
    exact = until.groupBy("day").agg(F.count_distinct("id").alias("exact"))
    return found.join(exact, "day").select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "tx_count", "amount", "exact",
        (F.abs(F.col("accounts") / F.col("exact") - 1) <= SKETCH_ERROR).alias("is_close"))


@query
def broken_lines(spark, d):
    """An uploaded file in which some lines lack fields and others have too many: those are rejected with their text."""
    path = scratch_path(spark, "broken")
    # A separator that no line holds leaves the lines, and the header, as they are.
    views.broken_upload(spark, d).write.option("header", True).option("sep", "\u0001").csv(path)
    rows = ingest.coerce_upload(readers.read_upload(spark, path, line="line"), line="line")
    valid, rejected = ingest.validate(rows, line="line")
    both = valid.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)
    return both.groupBy("reason", F.coalesce("line", F.lit("-")).alias("line")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(amounts.money_sum(F.when(F.col("line").isNull(), F.col("amount"))), 4).alias("amount"))


@query
def empty_scores(spark, d):
    """No payments: no scores, but all their columns."""
    return ledger_scores_of(views.ledger(spark, d).filter("type = 'no such type'"))


@query
def display_table(spark, d):
    return reports.display_table(ledger_scores(spark, d))


@query
def request_payload(spark, d):
    """The text that a scoring server gets."""
    return reports.request_payload(features.extract(views.ledger(spark, d)))


@query
def request_rows(spark, d):
    """The rows that a scoring server reads from that text."""
    return reports.parse_request(reports.request_payload(features.extract(views.ledger(spark, d))))


@query
def response_scores(spark, d):
    """Scores that come back as JSON lists, one per request, keyed by account again."""
    scored = cut(ledger_scores(spark, d))
    requests = cut(reports.request_payload(scored))
    asked = reports.parse_request(requests).select("request_id", "pos", "id")
    answers = (
        asked.join(scored.select("id", scoring.SCORE), "id").groupBy("request_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", scoring.SCORE))).alias("rows"))
        .select("request_id", F.to_json(F.struct(F.col("rows")[scoring.SCORE].alias("predictions"))).alias("response"))
    )
    return asked.join(reports.parse_response(answers), ["request_id", "pos"]).select("id", scoring.SCORE)


@query
def features_csv(spark, d):
    path = scratch_path(spark, "features")
    writers.export_csv(features.extract(views.ledger(spark, d)), path)
    schema = T.StructType([
        T.StructField("id", T.StringType()),
        *[T.StructField(c, T.DoubleType() if c.startswith("amount") else T.LongType()) for c in FEATURES],
    ])
    return readers.read_csv(spark, path, schema)


@query
def predictions_csv(spark, d):
    path = scratch_path(spark, "predictions")
    scored = ledger_scores(spark, d)
    writers.export_csv(scored.select("id", scoring.SCORE, "label"), path, [F.desc(scoring.SCORE), F.col("id")])
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField(scoring.SCORE, T.DoubleType()),
                           T.StructField("label", T.StringType())])
    return readers.read_csv(spark, path, schema)


# --- augmentation ------------------------------------------------------------------------------

@query
def scaled_transactions(spark, d):
    scaled = augment.scale(views.transfers(spark, d).withColumn("transaction_date", F.to_date("ts")))
    return scaled.select("seq", "sender", "receiver", F.round("amount", 6).alias("amount"), *text("ts"),
                         F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date"))


@query
def ring_rows(spark, d):
    rows = augment.ring_rows(views.ledger(spark, d))
    return rows.withColumns({"amount": F.round("amount", 6), "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss")})


@query
def ring_injection(spark, d):
    joined = augment.inject_rings(views.ledger(spark, d))
    return joined.select("sender", "receiver", F.round("amount", 6).alias("amount"), *text("ts"), "is_fraud")


# --- model and evaluation ----------------------------------------------------------------------

def scored_with_labels(spark, d) -> DataFrame:
    return features.with_labels(
        ledger_scores(spark, d).select("id", scoring.SCORE), features.labels(views.ledger(spark, d)))


def weighted_split(spark, d) -> tuple[DataFrame, DataFrame]:
    """Training and test accounts; the class weight is that of all labelled accounts."""
    return model.split(cut(model.with_class_weight(cut(labelled_ledger(spark, d)))))


@query
def rf_predictions(spark, d):
    training, test = weighted_split(spark, d)
    return model.prediction_table(model.predict(model.train(training), test))


@query
def rf_prediction_facts(spark, d):
    """What holds of every prediction whatever the trees: its inputs, weight and the threshold's use."""
    training, test = weighted_split(spark, d)
    found = model.prediction_table(model.predict(model.train(training), test)).join(test.select("id", "weight"), "id")
    score = F.col(scoring.SCORE)
    return found.select(
        "id", "label", F.round("weight", 9).alias("weight"), *[F.col("features")[i].alias(c) for i, c in enumerate(MODEL_FEATURES)],
        ((score >= 0) & (score <= 1)).alias("is_probability"),
        (F.col("prediction_custom") == (score > model.THRESHOLD).cast("int")).alias("threshold_holds"),
        (F.col("prediction") == (score > 0.5).cast("double")).alias("majority_holds"))


def forest_run(spark, d) -> tuple[DataFrame, DataFrame, dict, str]:
    training, test = weighted_split(spark, d)
    fitted = model.train(training)
    predictions = cut(model.predict(fitted, test))
    metrics = {"pr_auc": model.evaluator_pr_auc(predictions), "f1": model.multiclass_metric(predictions)}
    path = scratch_path(spark, "run")
    model.save_run(fitted, metrics, path, training)
    return predictions, test, metrics, path


@query
def rf_metrics(spark, d):
    path = forest_run(spark, d)[-1]
    return model.load_run(spark, path)[1].select(F.explode("metrics").alias("metric", "value"))


@query
def rf_run_facts(spark, d):
    """The stored run against the one that was trained: parameters, metrics, reloaded scores, both forms of PR-AUC."""
    predictions, test, metrics, path = forest_run(spark, d)
    loaded, run = model.load_run(spark, path)
    again = model.predict(loaded, test).select("id", F.col(scoring.SCORE).alias("again"))
    apart = predictions.join(again, "id").agg(F.max(F.abs(F.col(scoring.SCORE) - F.col("again")))).scalar()
    exact = model.pr_auc(predictions).scalar()
    return run.select(
        F.col("params")["num_trees"].alias("num_trees"), F.col("params")["max_depth"].alias("max_depth"),
        F.array_join("input_columns", ",").alias("input_columns"),
        (F.abs(F.col("metrics")["f1"] - model.weighted_f1(predictions).scalar()) < 1e-9).alias("f1_kept"),
        (F.coalesce(apart, F.lit(0.0)) == 0).alias("scores_kept"),
        (F.abs(F.col("metrics")["pr_auc"] - exact) < PR_AUC_TOLERANCE).alias("pr_auc_agrees"))


@query
def rf_cross_validation(spark, d):
    training, _ = weighted_split(spark, d)
    fitted = model.cross_validate(training, trees=(10, 30), depths=(3,), folds=2)
    return model.cross_validation_table(fitted, spark)


@query
def rf_grid(spark, d):
    """The grid that was searched, and that each point got a metric."""
    training, _ = weighted_split(spark, d)
    fitted = model.cross_validate(training, trees=(10, 30), depths=(3, 4), folds=2)
    return model.cross_validation_table(fitted, spark).select("trees", "depth", F.col("pr_auc").between(0, 1).alias("is_share"))


@query
def rule_score_pr_auc(spark, d):
    return model.pr_auc(cut(scored_with_labels(spark, d)))


@query
def confusion_matrix(spark, d):
    judged = scored_with_labels(spark, d).withColumn(
        "prediction", (F.col(scoring.SCORE) >= LEDGER_SCORE.suspect).cast("int"))
    return reports.confusion(judged)


@query
def confusion_wide(spark, d):
    judged = scored_with_labels(spark, d).withColumn(
        "prediction", (F.col(scoring.SCORE) >= LEDGER_SCORE.suspect).cast("int"))
    return reports.confusion_wide(judged)


def anomaly_scores_of(spark, d) -> DataFrame:
    found = cut(features.extract(views.ledger(spark, d), "proxy"))
    return isolation.score(found, isolation.fit(found, ADDITIVE_FEATURES))


@query
def anomaly_facts(spark, d):
    """What holds of every anomaly score whatever the trees."""
    return anomaly_scores_of(spark, d).select("id", F.col(isolation.SCORE).between(0, 1).alias("is_share"))


@query
def anomaly_pr_auc(spark, d):
    found = features.with_labels(anomaly_scores_of(spark, d).select("id", isolation.SCORE), features.labels(views.ledger(spark, d)))
    return model.pr_auc(cut(found), isolation.SCORE)


@query
def threshold_sweep(spark, d):
    return model.threshold_sweep(scored_with_labels(spark, d), THRESHOLDS)


@query
def medallion_features(spark, d):
    root = scratch_path(spark, "medallion")
    paths = medallion.run(spark, views.raw_export(spark, d), root, copies=3)
    f = readers.read_table(spark, paths["ml_features"])
    return f.select("id", *ADDITIVE_FEATURES[:3], "cluster_size", "triangle_count")


# --- time --------------------------------------------------------------------------------------

@query
def velocity_1h(spark, d):
    return temporal.velocity(views.transfers(spark, d)).select("seq", "sender", "velocity_count", "velocity_amount")


@query
def amount_zscore(spark, d):
    return temporal.amount_deviation(views.transfers(spark, d)).select(
        "seq", "sender", "prior_count", F.round("prior_mean", 8).alias("prior_mean"),
        F.round("prior_std", 6).alias("prior_std"), F.round("amount_z", 6).alias("amount_z"))


@query
def decayed_zscore(spark, d):
    return temporal.decayed_deviation(views.transfers(spark, d)).select(
        "seq", "sender", F.round("prior_weight", 6).alias("prior_weight"), F.round("decayed_mean", 6).alias("decayed_mean"),
        F.round("decayed_std", 5).alias("decayed_std"), F.round("decayed_z", 3).alias("decayed_z"))


@query
def hourly_windows(spark, d):
    return temporal.window_totals(views.transfers(spark, d), "1 hour").select(
        "sender", *text("window_start", "window_end"), "tx_count", "tx_amount")


@query
def sliding_windows(spark, d):
    return temporal.window_totals(views.transfers(spark, d), "1 hour", "30 minutes").select(
        "sender", *text("window_start", "window_end"), "tx_count", "tx_amount")


@query
def session_windows(spark, d):
    return temporal.sessions(views.transfers(spark, d), 7200).select(
        "sender", *text("session_start", "session_end"), "tx_count", "tx_amount")


# --- rings -------------------------------------------------------------------------------------

@query
def cycles_len3(spark, d):
    return rings.cycles(graph.edges(views.ledger(spark, d)), (3,)).select("length", "ring")


@query
def cycles_len4_by_account(spark, d):
    found = rings.cycles(graph.edges(views.transfers(spark, d)), (4,))
    return found.groupBy(F.col("members")[0].alias("id")).agg(F.count(F.lit(1)).alias("rings"))


RECALL_RINGS = {"n_rings": 200, "size": (3, 5), "rewire": 0.15, "noise": (1, 2)}


def with_drawn_rings(spark, d) -> tuple[DataFrame, DataFrame]:
    base = views.payments(spark, d)
    drawn = cut(augment.ring_rows(base, **RECALL_RINGS))
    return drawn, base.select("sender", "receiver", "amount").unionByName(drawn.select("sender", "receiver", "amount"))


@query
def ring_recall(spark, d):
    drawn, joined = with_drawn_rings(spark, d)
    return rings.ring_recall(drawn, graph.edges(joined))


@query
def cycles_len5(spark, d):
    """Payments alone have no cycle: those found run over drawn rings, and over payments that join them."""
    return rings.cycles(graph.edges(with_drawn_rings(spark, d)[1]), (5,)).select("length", "ring")


LONG_RINGS = {"n_rings": 150, "size": (5, 10), "rewire": 0.05, "noise": (2, 4)}


def drawn_long_rings(spark, d) -> tuple[DataFrame, DataFrame]:
    """Drawn rings of 5 to 10 accounts of the ledger, and the graph of the drawn payments."""
    drawn = cut(augment.ring_rows(views.ledger(spark, d), **LONG_RINGS))
    return drawn, graph.edges(drawn.select("sender", "receiver", "amount"))


@query
def long_rings_by_account(spark, d):
    return rings.by_account(rings.long_cycles(drawn_long_rings(spark, d)[1], (6, 7, 8, 9, 10)))


@query
def long_ring_recall(spark, d):
    """Of the drawn rings, how many are whole, and how many the search for rings of 5 to 10 accounts finds."""
    drawn, e = drawn_long_rings(spark, d)
    return rings.searched_recall(drawn, rings.long_cycles(e, (5, 6, 7, 8, 9, 10)))


@query
def timed_rings(spark, d):
    """Rings of three and four transfers, each at most a day after the one before."""
    found = rings.timed_rings(views.transfers(spark, d), (3, 4), 86_400)
    return found.select("length", "ring", F.concat_ws(">", F.transform("payments", lambda p: p.cast("string"))).alias("payments"),
                        *text("first_ts", "last_ts"), "amount")


# --- dense parts, influence --------------------------------------------------------------------

@query
def strong_components(spark, d):
    return strong.strong_components(graph.edges(views.ledger(spark, d)))


@query
def core_numbers(spark, d):
    return cores.core_numbers(cut(graph.edges(views.ledger(spark, d))))


@query
def dense_subgraph(spark, d):
    return cores.dense_subgraph(cut(graph.edges(views.ledger(spark, d)))).withColumn("density", F.round("density", 9))


@query
def risk_walk(spark, d):
    tx = views.ledger(spark, d)
    found = influence.risk_walk(cut(graph.edges(tx)), features.labels(tx).filter("label = 1"), tolerance=RISK_TOLERANCE)
    return found.withColumn("risk", F.round("risk", 9))


@query
def communities(spark, d):
    return influence.communities(cut(graph.edges(views.ledger(spark, d))), rounds=COMMUNITY_ROUNDS)


@query
def community_modularity(spark, d):
    e = cut(graph.edges(views.ledger(spark, d)))
    return influence.modularity(e, influence.communities(e, rounds=COMMUNITY_ROUNDS)).withColumn("modularity", F.round("modularity", 9))


# --- streaming ---------------------------------------------------------------------------------

STREAM = T.StructType([T.StructField("seq", T.LongType()), *TRANSACTIONS.fields])


CLOSING = "closing"


def closing_slices(parts, last):
    """The slices, then one row far later than all of them, then another that lets the moved watermark act."""
    yield from parts
    later = F.make_dt_interval(days=F.lit(30))
    for shift in (1, 2):
        yield last.select(
            F.lit(-shift).cast("bigint").alias("seq"), F.lit(CLOSING).alias("sender"), F.lit(CLOSING).alias("receiver"),
            F.lit(0.0).alias("amount"), (F.col("ts") + later * shift).alias("ts"), F.lit(None).cast("string").alias("type"), F.lit(0).alias("is_fraud"))


def replay_transfers(spark, d, name, start, closing=False):
    """Run a streaming query over the transfers, arriving in four equal slices in order of their sequence number."""
    root = scratch_path(spark, name)
    landing, out, state = f"{root}/landing", f"{root}/out", f"{root}/state"
    tx = views.transfers(spark, d).select(*STREAM.fieldNames())
    parts = replay.ranked_slices(tx, [F.col("seq")], SLICES)
    replay.drive(
        closing_slices(parts, tx.agg(F.max("ts").alias("ts"))) if closing else parts, landing,
        lambda: start(replay.open_stream(spark, landing, STREAM), out, state),
    )
    return out


def scored_stream(spark, d):
    total = views.transfers(spark, d).count()
    return replay_transfers(spark, d, "live", lambda stream, out, state: live.run(
        stream, out, state, lambda f: scoring.rule_score(f, LEDGER_SCORE), total, LEDGER_SCORE))


@query
def stream_edges_final(spark, d):
    out = replay_transfers(spark, d, "edges", lambda stream, out, state: live.to_versions(
        graph.edges(stream), out, state))
    return live.current_versions(spark, out, ["src", "dst"]).select(
        "src", "dst", "transaction_count", F.round("total_amount", 4).alias("total_amount"))


@query
def stream_progress(spark, d):
    return live.history(spark, scored_stream(spark, d), "progress").withColumn("pct", F.round("pct", 6))


@query
def stream_top8(spark, d):
    return live.history(spark, scored_stream(spark, d), "top").select("batch_id", "id", scoring.SCORE)


@query
def stream_scores_final(spark, d):
    return live.latest(spark, scored_stream(spark, d), "scores")


@query
def stream_velocity(spark, d):
    out = replay_transfers(spark, d, "velocity", lambda stream, out, state: live.to_versions(
        live.live_velocity(stream), out, state))
    return live.current_versions(spark, out, ["sender", "window_start", "window_end"]).select(
        "sender", *text("window_start", "window_end"), "tx_count", "tx_amount")


@query
def stream_velocity_1h(spark, d):
    """Velocity of each transaction over the stream, its rows out once no other can join them."""
    def start(stream, out, state):
        return live.to_table(live.live_transaction_velocity(stream), out, state)

    out = replay_transfers(spark, d, "velocity-1h", start, closing=True)
    return spark.read.parquet(out).filter(F.col("sender") != CLOSING).select("seq", "sender", "velocity_count", "velocity_amount")


@query
def stream_sessions(spark, d):
    """Event-time sessions; one closing row after the last slice moves the watermark past all of them."""
    def start(stream, out, state):
        return live.to_table(live.live_sessions(stream, "2 hours"), out, state)

    out = replay_transfers(spark, d, "sessions", start, closing=True)
    return spark.read.parquet(out).filter(F.col("sender") != CLOSING).select(
        "sender", *text("session_start", "session_end"), "tx_count", "tx_amount")


@query
def stream_model_scores(spark, d):
    """The last state of a stream scored by a trained forest, with the batch features the model was trained on."""
    fitted = model.train(model.with_class_weight(stored(labelled_ledger(spark, d), "training")), trees=5)

    def scorer(f):
        return model.predict(fitted, f).select(*f.columns, scoring.SCORE)

    total = views.transfers(spark, d).count()
    out = replay_transfers(spark, d, "model", lambda stream, out, state: live.run(stream, out, state, scorer, total))
    scored = live.latest(spark, out, "scores")
    batch = scorer(features.extract(views.transfers(spark, d))).select("id", F.col(scoring.SCORE).alias("batch_score"))
    return scored.join(batch, "id", "left").select(
        "id", *FEATURES, (F.abs(F.col(scoring.SCORE) - F.col("batch_score")) < 1e-12).alias("as_in_batch"),
        (F.col("label") == scoring.band_of(F.col("batch_score"))).alias("band_as_in_batch"))


@query
def stream_dedup(spark, d):
    def start(stream, out, state):
        copies = stream.filter("type = 'error'")
        return live.to_table(live.live_dedup(stream.unionByName(copies), ["seq"]), out, state)

    out = replay_transfers(spark, d, "dedup", start)
    return spark.read.parquet(out).select("seq", "sender", "receiver", "amount", *text("ts"))
