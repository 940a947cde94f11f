"""Rule score and risk bands."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.functions.draws import uniform_between
from ledgerweb.functions.ordered import global_rank
from ledgerweb.operators import features as feature_ops
from ledgerweb.schema import DEFAULT_SCORE, ScoreConfig

SCORE = "fraud_score"
BANDS = ("FRAUD", "SUSPECT", "LEGIT")


def rule_score(
    f: DataFrame, config: ScoreConfig = DEFAULT_SCORE, jitter: float = 0.0, salt: str = "jitter"
) -> DataFrame:
    """Add `fraud_score` in [0, 1]. Rules whose columns are absent do not fire.

    Rounding to four decimals puts sums such as 0.25 + 0.25 + 0.2 exactly on a band border.
    """
    rules = [
        ("tx_count_out", F.col("tx_count_out") > config.tx_out, config.w_tx_out),
        ("amount_out", F.col("amount_out") > config.amount_out, config.w_amount_out),
        ("amount_in", F.col("amount_in") < config.amount_in, config.w_amount_in),
        ("triangle_count", F.col("triangle_count") == 0, config.w_no_triangle),
        ("cluster_size", F.col("cluster_size") == 1, config.w_isolated),
    ]
    score = F.lit(0.0)
    for column, fires, weight in rules:
        if column in f.columns:
            score = score + F.when(fires, F.lit(float(weight))).otherwise(F.lit(0.0))
    if jitter:
        score = score + uniform_between(-jitter, jitter, salt, "id")
    return f.withColumn(SCORE, F.round(F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)), 4))


def band_of(score: Column, config: ScoreConfig = DEFAULT_SCORE) -> Column:
    return (
        F.when(score >= config.fraud, "FRAUD").when(score >= config.suspect, "SUSPECT").otherwise("LEGIT")
    )


def band(df: DataFrame, score_col: str = SCORE, config: ScoreConfig = DEFAULT_SCORE) -> DataFrame:
    """Add the risk band as `label`."""
    return df.withColumn("label", band_of(F.col(score_col), config))


def with_scores(f: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach scores by account id, never by position."""
    return f.join(scores.select("id", SCORE), "id", "left")


def score_batch(
    tx: DataFrame,
    scorer: Callable[[DataFrame], DataFrame] = rule_score,
    config: ScoreConfig = DEFAULT_SCORE,
) -> DataFrame:
    """All transactions at once → features, score and band per account."""
    return band(scorer(feature_ops.extract(tx)), config=config)


def by_risk(scored: DataFrame, *, ranked: bool = False) -> DataFrame:
    """All accounts, riskiest first; with `ranked`, the position as a column."""
    order = [F.desc(SCORE), F.col("id")]
    return global_rank(scored, order) if ranked else scored.orderBy(*order)


def top_scored(scored: DataFrame, k: int = 8) -> DataFrame:
    return scored.orderBy(F.desc(SCORE), "id").limit(k)


def top_alerts(scored: DataFrame, k: int = 10, config: ScoreConfig = DEFAULT_SCORE) -> DataFrame:
    return top_scored(scored.filter(F.col(SCORE) >= config.fraud), k)


def risk_bands(scored: DataFrame, config: ScoreConfig = DEFAULT_SCORE) -> DataFrame:
    """`label, accounts, share`, with a row for every band even where it is empty."""
    counted = scored.groupBy(band_of(F.col(SCORE), config).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    wide = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(F.when(F.col("label") == b, F.col("n"))), F.lit(0)).alias(b) for b in BANDS],
    )
    return wide.select(
        "total", F.inline(F.array(*[F.struct(F.lit(b).alias("label"), F.col(b).alias("accounts")) for b in BANDS]))
    ).select("label", "accounts", F.round(F.try_divide("accounts", "total"), 6).alias("share"))


def alerts_per_group(scored: DataFrame, group: str, k: int) -> DataFrame:
    """The k riskiest accounts of every group (top-k per group keeps k rows before the shuffle)."""
    w = W.partitionBy(group).orderBy(F.desc(SCORE), "id")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
