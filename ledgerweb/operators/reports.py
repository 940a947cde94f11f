"""Summaries, histograms and exchange formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.amounts import rupees
from ledgerweb.functions.ordered import global_rank
from ledgerweb.operators.graph import nodes
from ledgerweb.operators.scoring import SCORE
from ledgerweb.operators.sketches import size_for
from ledgerweb.schema import DEFAULT_SCORE, FEATURES, ScoreConfig

LOG_BINS = 14


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column count per table."""
    profiles = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(len(df.columns)).alias("column_count"), F.lit(",".join(df.columns)).alias("columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def label_counts(tx: DataFrame) -> DataFrame:
    """Row count and fraud row count in one pass."""
    return tx.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("is_fraud") == 1).alias("fraud_rows"))


def feature_summary(f: DataFrame) -> DataFrame:
    return f.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.max("degree").alias("max_degree"),
        F.max("amount_out").alias("max_amount_out"),
        F.count_if(F.col("triangle_count") == 0).alias("zero_triangle_nodes"),
        F.count_if(F.col("cluster_size") == 1).alias("isolated_nodes"),
    )


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("accounts"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("accounts"))


def confusion_wide(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per label, one column per predicted class."""
    return (
        df.groupBy(label).pivot(prediction, [0, 1]).agg(F.count(F.lit(1)))
        .withColumnsRenamed({"0": "predicted_0", "1": "predicted_1"})
        .fillna(0, subset=["predicted_0", "predicted_1"])
    )


def degree_hist(f: DataFrame) -> DataFrame:
    return f.groupBy("degree").agg(F.count(F.lit(1)).alias("accounts")).orderBy("degree")


def log_hist(f: DataFrame, column: str = "amount_out", bins: int = LOG_BINS) -> DataFrame:
    """Counts in `bins` equal steps of log10 between max(min, 1) and max(max, 2).

    Values below the first edge are left out, the last bin includes its upper edge, and empty
    bins are kept. Rows are reduced to one per bin before the bounds meet the bin list.
    """
    value = F.col(column)
    bounds = f.agg(
        F.log10(F.greatest(F.min(value), F.lit(1.0))).alias("lo"),
        F.log10(F.greatest(F.max(value), F.lit(2.0))).alias("hi"),
    )
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    ranged = f.select(value.alias("v"), lo.alias("lo"), hi.alias("hi")).filter("v >= 1 AND log10(v) >= lo")
    step = F.try_divide(F.log10("v") - F.col("lo"), F.col("hi") - F.col("lo"))
    last = F.lit(bins - 1)
    counted = ranged.groupBy(
        F.when(F.col("hi") == F.col("lo"), last)
        .otherwise(F.least(F.floor(step * bins), last)).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    # A fixed list of bins, joined to at most as many counts.
    edges = f.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).select(
        "bin", F.round(F.pow(F.lit(10.0), lo + F.col("bin") * (hi - lo) / F.lit(float(bins)))).alias("left_edge")
    )
    return edges.join(counted, "bin", "left").select(
        "bin", "left_edge", F.coalesce("n", F.lit(0)).cast("bigint").alias("accounts")
    )


def session_totals(tx: DataFrame, scored: DataFrame, config: ScoreConfig = DEFAULT_SCORE) -> DataFrame:
    """Transactions, distinct accounts and alerts."""
    accounts = nodes(tx).agg(F.count(F.lit(1)).alias("n"))
    alerts = scored.agg(F.count_if(F.col(SCORE) >= config.fraud).alias("n"))
    return tx.agg(F.count(F.lit(1)).alias("transactions")).select(
        "transactions", accounts.scalar().alias("accounts"), alerts.scalar().alias("alerts")
    )


def approximate_accounts(tx: DataFrame, within: float = 0.01, by: list[str] | None = None) -> DataFrame:
    """Distinct accounts from a sketch, where the exact count's shuffle is too much; `within` is three deviations of its error."""
    ends = tx.select(*(by or []), F.explode(F.array("sender", "receiver")).alias("id"))
    return ends.groupBy(*(by or [])).agg(F.hll_sketch_estimate(F.hll_sketch_agg("id", size_for(within))).alias("accounts"))


def recent(tx: DataFrame, n: int = 20, sequence: str = "seq") -> DataFrame:
    """The n latest rows, newest first."""
    return tx.orderBy(F.desc(sequence)).limit(n)


def display_table(scored: DataFrame) -> DataFrame:
    """Scored accounts with their amounts and score as text."""
    return scored.select(
        "id", F.format_string("%.4f", SCORE).alias("score_text"),
        rupees("amount_in").alias("amount_in_text"), rupees("amount_out").alias("amount_out_text"),
        "degree", "tx_count_in", "tx_count_out", "cluster_size", "triangle_count",
    )


def request_payload(f: DataFrame, chunk: int = 1000) -> DataFrame:
    """Scoring requests as JSON text, `chunk` accounts each: `request_id, records, payload`.

    Chunks are cut from the global order by id, so each has a bounded number of records. Amounts are written with four
    decimals and never with an exponent, so the text doesn't depend on how an engine prints doubles.
    """
    columns = [F.col(c).cast("decimal(38,4)").alias(c) if c.startswith("amount") else F.col(c) for c in FEATURES]
    numbered = global_rank(f.select("id", *columns), [F.col("id")], "position")
    record = F.struct("position", F.struct("id", *FEATURES).alias("record"))
    return (
        numbered.groupBy(F.floor((F.col("position") - 1) / chunk).cast("bigint").alias("request_id"))
        .agg(F.sort_array(F.collect_list(record)).alias("rows"))
        .select(
            "request_id", F.size("rows").alias("records"),
            F.to_json(F.struct(F.col("rows.record").alias("dataframe_records"))).alias("payload"),
        )
    )


def parse_request(payloads: DataFrame) -> DataFrame:
    """JSON requests → one feature row per record, with its place in the request."""
    record = (
        "struct<id:string,degree:bigint,tx_count_in:bigint,tx_count_out:bigint,amount_in:double,"
        "amount_out:double,cluster_size:bigint,triangle_count:bigint>"
    )
    body = F.from_json("payload", f"struct<dataframe_records:array<{record}>>")
    return payloads.select(
        "request_id", F.posexplode(body["dataframe_records"]).alias("pos", "r")
    ).select("request_id", "pos", "r.*")


def parse_response(responses: DataFrame) -> DataFrame:
    """JSON answers `{"predictions": [...]}` or `{"outputs": [...]}` → `request_id, pos, fraud_score`."""
    body = F.from_json("response", "struct<predictions:array<double>,outputs:array<double>>")
    return responses.select(
        "request_id", F.posexplode(F.coalesce(body["predictions"], body["outputs"])).alias("pos", SCORE)
    )
