"""Training, scoring and evaluating the account classifier."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.draws import uniform
from ledgerweb.functions.lineage import stored
from ledgerweb.functions.ordered import global_rank, running
from ledgerweb.operators.scoring import SCORE
from ledgerweb.schema import MODEL_FEATURES

# Fixed values of the reference forest.
NUM_TREES = 30
MAX_DEPTH = 3
SEED = 42
THRESHOLD = 0.1


def class_ratio(df: DataFrame, label: str = "label") -> DataFrame:
    """`negatives, positives, ratio`; the ratio is NULL without positives."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")
    ).withColumn("ratio", F.try_divide("negatives", "positives"))


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Positives weigh negatives/positives, all others 1."""
    ratio = class_ratio(df, label).select("ratio").scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def with_split(df: DataFrame, fraction: float = 0.8, salt: str = "42", key: str = "id") -> DataFrame:
    """Add `split` (train or test) from a hash of the id: the same under any partitioning."""
    return df.withColumn("split", F.when(uniform(salt, key) < fraction, "train").otherwise("test"))


def split(df: DataFrame, fraction: float = 0.8, salt: str = "42", key: str = "id") -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, fraction, salt, key)
    return marked.filter("split = 'train'").drop("split"), marked.filter("split = 'test'").drop("split")


def smote(df: DataFrame, columns: list[str], label: str = "label", per_row: int = 1, salt: str = "smote") -> DataFrame:
    """Synthetic positives `id, <columns>, label` between pairs of positive rows.

    Positives stand in one hash order, as in a circle; draw j pairs a row with the one j + 1 places on. A row is never paired
    with itself: one positive in all gives no rows, and fewer than `per_row` + 1 give fewer draws.
    """
    positives = df.filter(F.col(label) == 1).select("id", *[F.col(c).cast("double").alias(c) for c in columns])
    hashed = positives.withColumn("hash", F.md5(F.concat_ws(":", F.lit(salt), "id")))
    placed = stored(global_rank(hashed, [F.col("hash"), F.col("id")], "place").drop("hash"), "positives")
    count = placed.agg(F.count(F.lit(1))).scalar()
    draws = placed.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(per_row - 1)))).withColumn(
        "other", (F.col("place") + F.col("draw")) % count + 1)
    partners = placed.select(F.col("place").alias("other"), F.struct(*columns).alias("partner"))
    paired = draws.filter(F.col("draw") + 1 < count).join(partners, "other")
    u = uniform(salt, F.lit("step"), "id", "draw")
    return paired.select(
        F.concat_ws("#", "id", F.col("draw").cast("string")).alias("id"),
        *[(F.col(c) + u * (F.col("partner")[c] - F.col(c))).alias(c) for c in columns],
        F.lit(1).alias(label),
    )


def forest(columns: list[str], trees: int = NUM_TREES, depth: int = MAX_DEPTH, seed: int = SEED) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="features"),
        RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight",
                               numTrees=trees, maxDepth=depth, seed=seed),
    ])


def train(df: DataFrame, columns: list[str] = MODEL_FEATURES, **options) -> PipelineModel:
    """Weighted random forest over `columns`; adds the class weight where it is missing.

    A fitted forest keeps its training summary, which holds on to the session and cannot be sent
    to executors once that session has observed a metric. The copy has no summary.
    """
    if "weight" not in df.columns:
        df = with_class_weight(df)
    return forest(columns, **options).fit(df).copy()


def predict(model: PipelineModel, df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add `fraud_score` (probability of class 1), `prediction` and `prediction_custom`."""
    scored = model.transform(df).withColumn(SCORE, vector_to_array("probability")[1])
    return scored.withColumn("prediction_custom", (F.col(SCORE) > threshold).cast("int"))


def prediction_table(predictions: DataFrame) -> DataFrame:
    """The columns that are kept of a prediction run, with the features as an array."""
    return predictions.select(
        "id", vector_to_array("features").alias("features"), "label", "prediction", "prediction_custom", SCORE
    )


def cross_validate(
    df: DataFrame,
    columns: list[str] = MODEL_FEATURES,
    trees: Iterable[int] = (10, NUM_TREES),
    depths: Iterable[int] = (MAX_DEPTH, 5),
    folds: int = 3,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Forest parameters chosen by area under the precision-recall curve."""
    pipeline = forest(columns)
    rf = pipeline.getStages()[-1]
    grid = ParamGridBuilder().addGrid(rf.numTrees, list(trees)).addGrid(rf.maxDepth, list(depths)).build()
    if "weight" not in df.columns:
        df = with_class_weight(df)
    return CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, numFolds=folds, seed=SEED, parallelism=parallelism,
        evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR"),
    ).fit(df)


def cross_validation_table(model: CrossValidatorModel, spark) -> DataFrame:
    """`trees, depth, pr_auc` per grid point."""
    rows = []
    for params, metric in zip(model.getEstimatorParamMaps(), model.avgMetrics):
        named = {p.name: v for p, v in params.items()}
        rows.append((named["numTrees"], named["maxDepth"], float(metric)))
    return spark.createDataFrame(rows, "trees int, depth int, pr_auc double")


def evaluator_pr_auc(predictions: DataFrame) -> float:
    """Area under the precision-recall curve as MLlib computes it."""
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderPR"
    ).evaluate(predictions)


def multiclass_metric(predictions: DataFrame, name: str = "f1", prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol=prediction, metricName=name
    ).evaluate(predictions)


def weighted_f1(predictions: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row `f1`, from the counts of each class: their F1, weighted by how many rows bear the class."""
    ends = predictions.select(F.inline(F.array(
        F.struct(F.col(label).cast("double").alias("of"), F.lit(1).alias("actual"), F.lit(0).alias("said"), (F.col(label) == F.col(prediction)).cast("int").alias("both")),
        F.struct(F.col(prediction).cast("double").alias("of"), F.lit(0).alias("actual"), F.lit(1).alias("said"), F.lit(0).alias("both")))))
    per = ends.groupBy("of").agg(*[F.sum(c).alias(c) for c in ("actual", "said", "both")])
    # 2 * both / (actual + said) is the harmonic mean of precision and recall, and 0 where nothing was right.
    return per.agg((F.sum(F.col("actual") * 2 * F.col("both") / (F.col("actual") + F.col("said"))) / F.sum("actual")).alias("f1"))


def pr_auc(df: DataFrame, score: str = SCORE, label: str = "label") -> DataFrame:
    """Exact area under the precision-recall curve as one row `pr_auc`.

    Rows are reduced to one per score. The running counts over descending scores then come from
    a range-partitioned pass, since a model's scores may be as many as its accounts.
    """
    points = df.groupBy(F.col(score).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("tp")
    )
    curve = running(
        points, [], [F.col("s").desc()],
        sums={"seen_before": F.col("n"), "tp_before": F.col("tp")},
    )
    tp, seen = F.col("tp_before") + F.col("tp"), F.col("seen_before") + F.col("n")
    precision = tp / seen
    # Before the first point the curve is level: (0, first precision).
    earlier = F.when(F.col("seen_before") > 0, F.try_divide("tp_before", "seen_before")).otherwise(precision)
    # Recall rises by this score's positives over all positives; the division comes last.
    strip = F.col("tp") * (precision + earlier) / 2
    area = F.try_divide(F.sum(strip.cast("decimal(38,18)")).cast("double"), F.sum("tp"))
    return curve.agg(F.round(area, 9).alias("pr_auc"))


def threshold_sweep(
    df: DataFrame, thresholds: Iterable[float], score: str = SCORE, label: str = "label"
) -> DataFrame:
    """`threshold, tp, fp, fn, tn, precision, recall, f1`, all thresholds in one aggregation."""
    positive = F.col(label) == 1
    thresholds = list(thresholds)
    counts = [F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")]
    for i, t in enumerate(thresholds):
        hit = F.col(score) >= F.lit(float(t))
        counts += [F.count_if(hit & positive).alias(f"tp{i}"), F.count_if(hit & ~positive).alias(f"fp{i}")]
    rows = F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, t in enumerate(thresholds)
    ])
    return (
        df.agg(*counts).select("pos", "neg", F.inline(rows))
        .select("threshold", "tp", "fp", (F.col("pos") - F.col("tp")).alias("fn"),
                (F.col("neg") - F.col("fp")).alias("tn"))
        .transform(with_rates)
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to a table with tp, fp and fn; NULL where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": F.round(F.try_divide(tp, tp + fp), 9),
        "recall": F.round(F.try_divide(tp, tp + fn), 9),
        "f1": F.round(F.try_divide(2 * tp, 2 * tp + fp + fn), 9),
    })


def run_row(spark, model: PipelineModel, metrics: Mapping[str, float], input_columns: list[str]) -> DataFrame:
    """One row that describes a run; the parameters are read from the model itself."""
    rf: RandomForestClassificationModel = model.stages[-1]
    params = {"model": "RandomForest", "num_trees": str(rf.getNumTrees), "max_depth": str(rf.getMaxDepth()),
              "seed": str(rf.getSeed())}
    return spark.createDataFrame(
        [(params, {k: float(v) for k, v in metrics.items()}, list(input_columns))],
        "params map<string,string>, metrics map<string,double>, input_columns array<string>",
    )


def save_run(
    model: PipelineModel, metrics: Mapping[str, float], path: str, examples: DataFrame | None = None
) -> None:
    """Store model, run row and, where given, a five-row input example under `path`."""
    assembler: VectorAssembler = model.stages[0]
    model.write().overwrite().save(f"{path}/model")
    spark = examples.sparkSession if examples is not None else None
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
    columns = assembler.getInputCols()
    run_row(spark, model, metrics, columns).write.mode("overwrite").parquet(f"{path}/run")
    if examples is not None:
        (examples.select("id", *columns).orderBy("id").limit(5)
         .write.mode("overwrite").parquet(f"{path}/input_example"))


def load_run(spark, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/run")
