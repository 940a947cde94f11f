import json

import pytest

from ledgerweb.functions import amounts
from ledgerweb.operators import features, graph, model, reports, scoring
from ledgerweb.schema import FEATURES, ScoreConfig
from ledgerweb.sources.readers import sample_rows
from pyspark.sql import functions as F
from tests.helpers import by_id, random_pairs, tx

SCORED = "id string, fraud_score double, label int"


def table(spark, rows, columns=("degree", "tx_count_in", "tx_count_out", "amount_in", "amount_out", "cluster_size", "triangle_count")):
    types = {"amount_in": "double", "amount_out": "double"}
    return spark.createDataFrame(rows, ", ".join(["id string", *[f"{c} {types.get(c, 'long')}" for c in columns]]))


def test_sample_scores(spark):
    scored = scoring.score_batch(sample_rows(spark))
    assert by_id(scored, "fraud_score", "label") == {
        **{f"C100{i}": (0.35, "LEGIT") for i in range(1, 6)}, "M2001": (0.15, "LEGIT"), "M2002": (0.15, "LEGIT")}


@pytest.mark.parametrize("row,score,label", [
    ((9, 0, 6, 0.0, 500001.0, 1, 0), 1.0, "FRAUD"),
    ((9, 0, 6, 0.0, 500001.0, 2, 1), 0.7, "FRAUD"),
    ((9, 0, 5, 999.99, 500000.0, 2, 1), 0.2, "LEGIT"),
    ((9, 0, 6, 1000.0, 0.0, 1, 0), 0.55, "SUSPECT"),
    ((9, 0, 6, 1000.0, 0.0, 2, 0), 0.4, "SUSPECT"),
])
def test_rules_and_bands(spark, row, score, label):
    got = scoring.band(scoring.rule_score(table(spark, [("a", *row)]))).first()
    assert (got["fraud_score"], got["label"]) == (score, label)


def test_jitter_stays_in_range_and_repeats(spark):
    f = table(spark, [(f"a{i}", 9, 0, 6 * (i % 2), 5000.0 * (i % 2), 500001.0 * (i % 2), 2 - i % 2, i % 2) for i in range(50)])
    one, two = (by_id(scoring.rule_score(f, jitter=0.05), "fraud_score") for _ in range(2))
    plain = by_id(scoring.rule_score(f), "fraud_score")
    assert one == two and one != plain
    assert all(0 <= v <= 1 and abs(v - plain[k]) <= 0.05 for k, v in one.items())


def test_scores_are_joined_by_id(spark):
    f = table(spark, [("a", 1, 0, 1, 0.0, 1.0, 2, 0), ("b", 1, 0, 1, 0.0, 1.0, 2, 0)])
    scores = spark.createDataFrame([("b", 0.9), ("a", 0.1)], "id string, fraud_score double")
    assert by_id(scoring.with_scores(f, scores), "fraud_score") == {"a": 0.1, "b": 0.9}


def test_bands_and_alerts(spark):
    df = spark.createDataFrame([("a", 0.7, 1), ("b", 0.9, 1), ("c", 0.1, 0), ("d", 0.9, 0)], SCORED)
    bands = {r["label"]: (r["accounts"], r["share"]) for r in scoring.risk_bands(df).collect()}
    assert bands == {"FRAUD": (3, 0.75), "SUSPECT": (0, 0.0), "LEGIT": (1, 0.25)}
    assert [r["id"] for r in scoring.top_alerts(df, 2).collect()] == ["b", "d"]
    assert [r["id"] for r in scoring.by_risk(df).collect()] == ["b", "d", "a", "c"]
    assert by_id(scoring.by_risk(df, ranked=True), "rank") == {"b": 1, "d": 2, "a": 3, "c": 4}
    empty = {r["label"]: (r["accounts"], r["share"]) for r in scoring.risk_bands(df.limit(0)).collect()}
    assert empty == {b: (0, None) for b in scoring.BANDS}


def test_summary_and_histograms(spark):
    f = features.extract(tx(spark, [("a", "b", 100), ("b", "c", 10), ("c", "a", 1), ("d", "d", 1)]))
    assert tuple(reports.feature_summary(f).first()) == (4, 2, 100.0, 1, 1)
    assert [tuple(r) for r in reports.degree_hist(f).collect()] == [(2, 4)]


def log_bins(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "amount_out double")
    return [r["accounts"] for r in reports.log_hist(df).orderBy("bin").collect()]


def test_log_histogram(spark):
    counts = log_bins(spark, [0, 0.5, 1, 1, 10, 10 ** 7, 10 ** 14])
    assert counts == [2, 1, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 1]
    assert log_bins(spark, [5, 5]) == [0] * 13 + [2]
    assert log_bins(spark, []) == [0] * 14


def test_display_and_text(spark):
    scored = scoring.rule_score(table(spark, [("a", 3, 1, 2, 1234567.5, 0.0, 2, 4)]))
    row = reports.display_table(scored).first()
    assert (row["score_text"], row["amount_in_text"], row["degree"], row["triangle_count"]) == ("0.0000", "₹1,234,567.50", 3, 4)
    assert scored.select(amounts.percent(F.lit(0.1234))).first()[0] == "12.3%"


def test_recent_and_totals(spark):
    t = tx(spark, [("a", "b", 9), ("b", "c", 9), ("c", "d", 9)]).withColumn("seq", F.monotonically_increasing_id())
    assert [r["sender"] for r in reports.recent(t, 2).collect()] == ["c", "b"]
    scored = spark.createDataFrame([("a", 0.9, 1), ("b", 0.2, 0)], SCORED)
    assert tuple(reports.session_totals(t, scored).first()) == (3, 4, 1)
    assert reports.approximate_accounts(t).first()[0] == 4
    assert tuple(reports.label_counts(t).first()) == (3, 0)


def test_request_and_response(spark):
    f = features.extract(tx(spark, random_pairs(30, 60, 2)))
    payloads = reports.request_payload(f, chunk=10)
    sizes = [r["records"] for r in payloads.collect()]
    assert all(n <= 10 for n in sizes) and sum(sizes) == f.count()
    record = json.loads(payloads.filter("request_id = 0").first()["payload"])["dataframe_records"][0]
    assert list(record) == ["id", *FEATURES]
    texts = {f'"amount_out":{r["amount_out"]:.4f}' for r in f.collect()}
    assert all(any(t in r["payload"] for r in payloads.collect()) for t in texts)
    back = reports.parse_request(payloads).select("id", *FEATURES)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, f.collect()))
    answers = spark.createDataFrame(
        [(0, '{"predictions":[0.1,0.9]}'), (1, '{"outputs":[0.5]}')], "request_id long, response string")
    assert sorted(map(tuple, reports.parse_response(answers).collect())) == [(0, 0, 0.1), (0, 1, 0.9), (1, 0, 0.5)]


def test_class_weight(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0), ("d", 0)], "id string, label int")
    assert by_id(model.with_class_weight(df), "weight") == {"a": 3.0, "b": 1.0, "c": 1.0, "d": 1.0}
    none = df.filter("label = 0")
    assert model.class_ratio(none).first()["ratio"] is None
    assert set(by_id(model.with_class_weight(none), "weight").values()) == {1.0}


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    train, test = model.split(df)
    again, _ = model.split(df.repartition(13))
    ids = {r["id"] for r in train.collect()}
    assert ids == {r["id"] for r in again.collect()} and not ids & {r["id"] for r in test.collect()}
    assert 0.75 < len(ids) / 2000 < 0.85


def test_pr_auc(spark):
    rows = [("a", 0.9, 1), ("b", 0.8, 0), ("c", 0.8, 1), ("d", 0.3, 0), ("e", 0.1, 1)]
    df = spark.createDataFrame(rows, SCORED)
    points, tp, seen = [], 0, 0
    for s in (0.9, 0.8, 0.3, 0.1):
        tp += sum(r[2] for r in rows if r[1] == s)
        seen += sum(r[1] == s for r in rows)
        points.append((tp / 3, tp / seen))
    area, previous = 0.0, (0.0, points[0][1])
    for p in points:
        area += (p[0] - previous[0]) * (p[1] + previous[1]) / 2
        previous = p
    assert model.pr_auc(df).first()[0] == round(area, 9)


def test_threshold_sweep_and_confusion(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("b", 0.8, 0), ("c", 0.2, 1), ("d", 0.1, 0)], SCORED)
    rows = {r["threshold"]: r for r in model.threshold_sweep(df, [0.15, 0.5, 0.95]).collect()}
    assert tuple(rows[0.5])[1:5] == (1, 1, 1, 1) and rows[0.5]["f1"] == 0.5
    assert rows[0.95]["precision"] is None and rows[0.15]["recall"] == 1.0
    judged = df.withColumn("prediction", (F.col("fraud_score") > 0.5).cast("int"))
    assert sorted(map(tuple, reports.confusion(judged).collect())) == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1)]
    wide = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in reports.confusion_wide(judged).collect()}
    assert wide == {0: (1, 1), 1: (1, 1)}
    assert sorted(map(tuple, reports.class_distribution(df).collect())) == [(0, 2), (1, 2)]


def test_smote(spark):
    rows = [(f"p{i}", float(i), float(10 * i), 1) for i in range(20)] + [("n", 500.0, 500.0, 0)]
    df = spark.createDataFrame(rows, "id string, x double, y double, label int")
    made = model.smote(df, ["x", "y"], per_row=2).collect()
    assert len(made) == 40 and all(r["label"] == 1 and 0 <= r["x"] <= 19 and 0 <= r["y"] <= 190 for r in made)
    assert not {(r["x"], r["y"]) for r in made} & {(x, y) for _, x, y, _ in rows}


@pytest.mark.parametrize("positives,expected", [(0, 0), (1, 0), (2, 2), (3, 6)])
def test_smote_never_pairs_a_row_with_itself(spark, positives, expected):
    df = spark.createDataFrame([(f"p{i}", float(i), 1) for i in range(positives)], "id string, x double, label int")
    made = model.smote(df, ["x"], per_row=2).collect()
    assert len(made) == expected and all(r["x"] not in (0.0, 1.0, 2.0) for r in made)


def test_forest_run(spark, tmp_path):
    rows = [(f"a{i}", i % 9, i % 7, (i % 5) * 4, int(i % 5 == 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, degree long, tx_count_in long, tx_count_out long, label int")
    train, test = model.split(df)
    fitted = model.train(train)
    predictions = model.predict(fitted, test).cache()
    auc = model.evaluator_pr_auc(predictions)
    assert auc > 0.9 and model.multiclass_metric(predictions) > 0.9
    assert all((r["fraud_score"] > 0.1) == bool(r["prediction_custom"]) for r in predictions.collect())
    assert abs(model.pr_auc(predictions).first()[0] - auc) < 1e-6
    model.save_run(fitted, {"pr_auc": auc}, str(tmp_path / "run"), train)
    loaded, run = model.load_run(spark, str(tmp_path / "run"))
    row = run.first()
    assert row["params"]["num_trees"] == "30" and row["params"]["max_depth"] == "3"
    assert abs(row["metrics"]["pr_auc"] - auc) < 1e-12
    assert spark.read.parquet(str(tmp_path / "run" / "input_example")).count() == 5
    same = by_id(model.prediction_table(model.predict(loaded, test)), "fraud_score")
    assert same == by_id(predictions, "fraud_score")


def test_forest_works_after_an_observed_metric(spark):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 10
    rows = [(f"a{i}", i % 9, i % 7, (i % 5) * 4, int(i % 5 == 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, degree long, tx_count_in long, tx_count_out long, label int")
    assert model.predict(model.train(df), df).repartition(3).count() == 100
