"""Cumulative graph state, per-batch features and scores, and windowed counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerweb.functions.amounts import MONEY_SUM, money, money_sum
from ledgerweb.functions.lineage import stored
from ledgerweb.operators import components, graph, scoring, triangles
from ledgerweb.schema import DEFAULT_SCORE, FEATURES, ScoreConfig
from ledgerweb.streaming import state

TOP_K = 8
COMPACT_EVERY = 10


# --- state -------------------------------------------------------------------------------------

def _both_ends(edges: DataFrame) -> DataFrame:
    """Edges as rows of either end, `id, other, is_out` and the totals: an account's rows are all its edges."""
    return edges.select(
        F.inline(F.array(
            F.struct(F.col("src").alias("id"), F.col("dst").alias("other"), F.lit(True).alias("is_out")),
            F.struct(F.col("dst").alias("id"), F.col("src").alias("other"), F.lit(False).alias("is_out")))),
        "transaction_count", "total_amount")


def _summary(scores: DataFrame, buckets: int, config: ScoreConfig) -> DataFrame:
    """`part, alerts, best` for whole buckets of scores: how many alerts each has, and its best rows."""
    parts = scores.withColumn("part", state.bucket_of("id", buckets))
    place = F.row_number().over(W.partitionBy("part").orderBy(F.desc(scoring.SCORE), "id"))
    best = parts.withColumn("_place", place).filter(F.col("_place") <= TOP_K).groupBy("part").agg(
        F.collect_list(F.struct(*scores.columns)).alias("best"))
    alerts = parts.groupBy("part").agg(F.count_if(F.col(scoring.SCORE) >= config.fraud).alias("alerts"))
    return alerts.join(best, "part")


def compact(spark: SparkSession, out_dir: str, batch_id: int, config: ScoreConfig, rows_per_bucket: int = state.ROWS_PER_BUCKET) -> None:
    """Store all tables whole as of `batch_id`, in as many buckets as their rows need by then."""
    for name in ("ends", "scores", "members"):
        rows = stored(state.table(spark, out_dir, name, batch_id + 1), "whole")
        if name == "members":  # of accounts that have not moved on to another component
            rows = rows.join(state.table(spark, out_dir, "scores", batch_id + 1).select("id", "component"), ["id", "component"], "left_semi")
        buckets = state.fitting(rows.count(), rows_per_bucket)
        state.store(rows, out_dir, name, batch_id, buckets, whole=True)
        if name == "scores":
            state.store(_summary(rows.drop("component"), buckets, config), out_dir, "summary", batch_id, 1, whole=True)
    for name in state.KEYS:
        state.drop_superfluous(spark, out_dir, name, batch_id)


# --- one batch ---------------------------------------------------------------------------------

def _new_triangles(now: DataFrame, new_links: DataFrame) -> DataFrame:
    """`id, more`: triangles through each account that have at least one of the new links `a, b`.

    Both other sides of such a triangle are links of the new one's ends, whose edges are all in `now`.
    """
    ends = new_links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    near = now.filter("id != other").select("id", "other").join(ends, "id", "left_semi").select(
        F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), F.lit(False).alias("fresh"))
    # Both ends of a link may have told of it; a new one is among them, and is named once more with its mark.
    marked = near.unionByName(new_links.select("a", "b", F.lit(True).alias("fresh"))).groupBy("a", "b").agg(F.max("fresh").alias("fresh"))
    return triangles.fresh_triangle_counts(graph.index_of(marked)).withColumnRenamed("triangle_count", "more")


def _merged_components(old: DataFrame, new_links: DataFrame) -> DataFrame:
    """`was, component, cluster_size` for the components that new links join, seeded with their ends' labels so far.

    An account not seen before is a component of its own, named after itself.
    """
    label = old.select("id", "component")
    joined = (
        new_links.join(label.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(label.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
        .select(F.coalesce("ca", "a").alias("src"), F.coalesce("cb", "b").alias("dst"))
        .filter("src <> dst").distinct()
    )
    named = stored(components.component_labels(stored(joined, "label-links")).select(F.col("id").alias("was"), "component"), "merged")
    sizes = old.groupBy(F.col("component").alias("was")).agg(F.first("cluster_size").alias("n"))
    sized = stored(named.join(sizes, "was", "left").select("was", "component", F.coalesce("n", F.lit(1)).alias("n")), "merged-sizes")
    total = sized.groupBy("component").agg(F.sum("n").alias("cluster_size"))
    return sized.select("was", "component").join(total, "component")


def rescored(
    spark: SparkSession, out_dir: str, batch_id: int, changed: DataFrame, before: DataFrame, scorer: Callable[[DataFrame], DataFrame], config: ScoreConfig
) -> DataFrame:
    """Features, component, score and band of the accounts that `changed` edges touch, directly or by component or triangle.

    `before` has the rows that the ends of changed edges had. Of the state only the buckets of such ends, of new triangles' corners, and of
    the members of components that new links join are read.
    """
    def known(ids: DataFrame) -> DataFrame:
        found = state.lookup(spark, out_dir, "scores", ids, batch_id)
        return _nothing_yet(spark) if found is None else found

    fresh_ends = _both_ends(changed)
    touched = stored(fresh_ends.select("id").distinct(), "touched")
    now = stored(before.join(fresh_ends, state.KEYS["ends"], "left_anti").unionByName(fresh_ends), "ends-now")
    additive = graph.features_of_ends(now)
    linked = before.filter("id != other").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    new_links = stored(graph.undirected(changed).join(linked, ["a", "b"], "left_anti"), "new-links")
    more = stored(_new_triangles(now, new_links), "new-triangles")
    merged = stored(_merged_components(stored(known(touched), "labels"), new_links), "components")
    joined = merged.select(F.col("was").alias("component"))
    listed = state.lookup(spark, out_dir, "members", joined, batch_id)
    candidates = touched.unionByName(more.select("id"))
    if listed is not None:
        candidates = candidates.unionByName(listed.select("id"))
    candidates = stored(candidates.distinct(), "candidates")
    old = stored(known(candidates), "old")
    # A list may still name accounts that have left for another component.
    members = old.join(joined, "component", "left_semi").select("id")
    ids = touched.unionByName(more.select("id")).unionByName(members).distinct()
    kept = old.select("id", *[F.col(c).alias(f"old_{c}") for c in (*FEATURES, "component")])
    fresh = additive.select("id", *[F.col(c).alias(f"new_{c}") for c in FEATURES[:5]])
    rows = (
        ids.join(kept, "id", "left").join(fresh, "id", "left").join(more, "id", "left")
        .withColumn("was", F.coalesce("old_component", "id"))
        .join(merged, "was", "left")
    )
    features = rows.select(
        "id", *[F.coalesce(f"new_{c}", f"old_{c}").alias(c) for c in FEATURES[:5]],
        F.coalesce("cluster_size", "old_cluster_size", F.lit(1)).cast("bigint").alias("cluster_size"),
        (F.coalesce("old_triangle_count", F.lit(0)) + F.coalesce("more", F.lit(0))).cast("bigint").alias("triangle_count"),
        F.coalesce("component", "was").alias("component"),
        (F.col("old_component").isNull() | F.col("component").isNotNull()).alias("moved"),
    )
    features = stored(features, "touched-features")
    state.store(features.filter("moved").select("component", "id"), out_dir, "members", batch_id, state.buckets_at(spark, out_dir, "members", batch_id))
    return scoring.band(scorer(features.drop("component", "moved")), config=config).join(features.select("id", "component"), "id")


def _nothing_yet(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "id string, degree bigint, tx_count_in bigint, tx_count_out bigint, amount_in double, "
                                     "amount_out double, cluster_size bigint, triangle_count bigint, component string")


def score_changes(
    spark: SparkSession, changed: DataFrame, batch_id: int, out_dir: str, scorer: Callable[[DataFrame], DataFrame],
    total_rows: int | None, config: ScoreConfig, compact_every: int = COMPACT_EVERY, rows_per_bucket: int = state.ROWS_PER_BUCKET,
) -> None:
    """Store a batch's changed edges, the scores they change, the best of all scores, and the progress.

    Every table replaces its own version of this batch and only reads older batches, so one that is repeated after a failure
    replaces its own output. The stored edges are read back through the caller's
    session: the one a micro-batch runs in has adaptive execution, and with it the splitting of
    skewed joins, turned off.
    """
    path = f"{out_dir}/edges/batch_id={batch_id}"
    changed.write.mode("overwrite").parquet(path)
    changed = spark.read.schema(changed.schema).parquet(path)
    ends = _both_ends(changed)
    before = state.lookup(spark, out_dir, "ends", ends.select("id"), batch_id)
    before = stored(ends.limit(0) if before is None else before, "ends-before")
    scores = stored(rescored(spark, out_dir, batch_id, changed, before, scorer, config), "rescored")
    state.store(ends, out_dir, "ends", batch_id, state.buckets_at(spark, out_dir, "ends", batch_id))
    buckets = state.buckets_at(spark, out_dir, "scores", batch_id)
    state.store(scores, out_dir, "scores", batch_id, buckets)
    # The best rows and the alerts of a bucket change with its scores; those of all buckets make the best of all.
    reread = state.read(spark, out_dir, "scores", batch_id + 1, state.touched_buckets(scores.select("id")))
    state.store(_summary(state.current(reread, "scores").drop("component"), buckets, config), out_dir, "summary", batch_id, 1)
    summary = stored(state.table(spark, out_dir, "summary", batch_id + 1), "summary")
    best = summary.select(F.inline("best"))
    scoring.top_scored(best, TOP_K).write.mode("overwrite").parquet(f"{out_dir}/top/batch_id={batch_id}")
    _progress(spark, out_dir, batch_id, changed, before, summary, total_rows)
    if batch_id % compact_every == compact_every - 1:
        compact(spark, out_dir, batch_id, config, rows_per_bucket)
        state.drop_superfluous(spark, out_dir, "edges", batch_id)


def _progress(spark: SparkSession, out_dir: str, batch_id: int, changed: DataFrame, before: DataFrame, summary: DataFrame, total_rows: int | None) -> None:
    """The transactions so far: those of the batch before, and what the changed edges have more than they had."""
    past = [n for n in state.versions(spark, f"{out_dir}/progress") if n < batch_id]
    done = F.lit(0).cast("bigint")
    if past:
        done = spark.read.parquet(f"{out_dir}/progress/batch_id={past[-1]}").select("rows_done").scalar()
    had = before.filter("is_out").select(F.col("id").alias("src"), F.col("other").alias("dst"), F.col("transaction_count").alias("had"))
    added = changed.join(had, ["src", "dst"], "left").agg(
        F.coalesce(F.sum(F.col("transaction_count") - F.coalesce("had", F.lit(0))), F.lit(0)).alias("added"))
    total = F.lit(total_rows).cast("bigint")
    alerts = summary.agg(F.coalesce(F.sum("alerts"), F.lit(0)).alias("n")).scalar()
    (
        added.select((done + F.col("added")).alias("rows_done"), total.alias("rows_total"))
        .select("rows_done", "rows_total", F.least(F.try_divide("rows_done", "rows_total"), F.lit(1.0)).alias("pct"), alerts.alias("alerts"))
        .write.mode("overwrite").parquet(f"{out_dir}/progress/batch_id={batch_id}")
    )


def run(
    stream: DataFrame,
    out_dir: str,
    checkpoint: str,
    scorer: Callable[[DataFrame], DataFrame] = scoring.rule_score,
    total_rows: int | None = None,
    config: ScoreConfig = DEFAULT_SCORE,
    trigger: dict | None = None,
    compact_every: int = COMPACT_EVERY,
    rows_per_bucket: int = state.ROWS_PER_BUCKET,
) -> StreamingQuery:
    """Keep the collapsed edges as streaming state and rescore the accounts that each batch touches."""
    spark = stream.sparkSession
    return (
        graph.edges(stream).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda df, n: score_changes(spark, df, n, out_dir, scorer, total_rows, config, compact_every, rows_per_bucket))
        .start()
    )


def latest(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """All rows of `edges` or `scores` after the last finished batch."""
    if table == "edges":
        ends = state.table(spark, out_dir, "ends").filter("is_out")
        return ends.select(F.col("id").alias("src"), F.col("other").alias("dst"), "transaction_count", "total_amount")
    return state.table(spark, out_dir, table).drop("component")


def history(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """What each batch stored, with its number."""
    return spark.read.parquet(f"{out_dir}/{table}").withColumn("batch_id", F.col("batch_id").cast("bigint")).drop("buckets", "bucket")


def live_velocity(stream: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Count and amount per sender and event-time window; rows later than `late` are dropped."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return (
        stream.withWatermark("ts", late).groupBy("sender", window)
        .agg(F.count(F.lit(1)).alias("tx_count"), money_sum("amount").alias("tx_amount"))
        .select("sender", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "tx_count", F.round("tx_amount", 4).alias("tx_amount"))
    )


def live_transaction_velocity(stream: DataFrame, seconds: int = 3600, late: str = "1 hour", key: str = "seq") -> DataFrame:
    """Per transaction, as `temporal.velocity`: count and amount its sender paid within the last `seconds`, itself included.

    Transactions leave a first aggregation, whose groups are single ones, when the watermark has passed them. A second one gathers those of a sender in
    windows of two time buckets of `seconds`, each starting one bucket after the one before: no window reaches further back than a bucket, so those of the later
    bucket find all they count there. A transaction's row comes out once, when no other can join its window any more. Rows later than `late` are
    dropped, as transactions and from the counts of others; `late_rows` says how many. `key` identifies a transaction.
    """
    one = (
        stream.withWatermark("ts", late).filter("sender IS NOT NULL AND ts IS NOT NULL").groupBy("sender", "ts", F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(money("amount")).alias("amt"))
    )
    near = one.groupBy("sender", F.window("ts", f"{2 * seconds} seconds", f"{seconds} seconds")).agg(
        F.collect_list(F.struct(F.unix_timestamp("ts").alias("sec"), "n", "amt", "ts", "key")).alias("all"))
    own = F.filter("all", lambda t: t["sec"] >= F.unix_timestamp("window.start") + seconds)
    each = near.select("sender", "all", F.explode(own).alias("own")).select("sender", "own", F.filter(
        "all", lambda t: t["sec"].between(F.col("own.sec") - seconds, F.col("own.sec"))).alias("within"))
    known = F.filter("within", lambda t: t["amt"].isNotNull())
    nothing = F.lit(0).cast(MONEY_SUM)
    count = F.aggregate("within", F.lit(0).cast("bigint"), lambda s, t: s + t["n"])
    amount = F.when(F.size(known) > 0, F.aggregate(known, nothing, lambda s, t: (s + t["amt"]).cast(MONEY_SUM)))
    # A transaction that came n times is one row, with n times the count and amount.
    times = F.col("own.n")
    repeated = F.when(times == 1, F.col("amount")).otherwise((F.col("amount").cast("decimal(30,8)") * times.cast("decimal(7,0)")).cast(MONEY_SUM))
    return each.select("sender", "own", count.alias("count"), amount.alias("amount")).select(
        F.col("own.key").alias(key), "sender", F.col("own.ts").alias("ts"), (F.col("count") * times).alias("velocity_count"),
        F.round(repeated.cast("double"), 4).alias("velocity_amount"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that operators of the query have dropped as too late, in the batches it still reports on."""
    return sum(op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators)


def live_sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return (
        stream.withWatermark("ts", late).groupBy("sender", F.session_window("ts", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("tx_count"), money_sum("amount").alias("tx_amount"))
        .select("sender", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                "tx_count", F.round("tx_amount", 4).alias("tx_amount"))
    )


def live_dedup(stream: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Drop copies of a row that arrive within the watermark's delay of the first one."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def to_table(stream: DataFrame, out_dir: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append finished rows as Parquet."""
    return (
        stream.writeStream.outputMode("append").format("parquet").option("path", out_dir)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def to_versions(stream: DataFrame, out_dir: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write each batch's changed rows to its own folder; the newest version of a key is current."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def current_versions(spark: SparkSession, out_dir: str, keys: list[str]) -> DataFrame:
    """The newest version of every key."""
    versions = spark.read.parquet(out_dir)
    rest = [c for c in versions.columns if c not in (*keys, "batch_id")]
    return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("v")).select(*keys, "v.*")
