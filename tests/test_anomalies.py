"""Isolation forest and decayed baseline against plain versions; velocity of single transactions on a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import scratch_path
from ledgerweb.operators import isolation, temporal
from ledgerweb.plans.queries import CLOSING, STREAM, closing_slices
from ledgerweb.streaming import live, replay
from tests.helpers import random_pairs

START = datetime(2024, 1, 1)


def accounts(spark, n=600, seed=1):
    rnd = random.Random(seed)
    rows = [(f"a{i}", rnd.gauss(0, 1), float(rnd.randint(0, 3)), 7.0, None if i % 50 == 0 else rnd.random()) for i in range(n)]
    rows += [("odd", 40.0, 90.0, 7.0, -30.0), ("nan", float("nan"), 1.0, 7.0, 0.5)]
    return rows, spark.createDataFrame(rows, "id string, x double, y double, same double, z double")


def plain_steps(tree, row):
    feature, cut, low, high, steps = tree
    node = 0
    while feature[node] >= 0:
        node = low[node] if row[feature[node]] < cut[node] else high[node]
    return steps[node]


@pytest.mark.parametrize("trees,sample", [(50, 64), (3, 1000), (1, 2)])
def test_forest_against_walking_it(spark, trees, sample):
    rows, df = accounts(spark)
    forest = isolation.fit(df, ["x", "y", "same", "z"], trees, sample)
    assert len(forest.trees) == trees and forest.sample == min(sample, len(rows) // trees)
    for feature, cut, low, high, steps in forest.trees:
        assert all(f in (-1, 0, 1, 3) for f in feature) and len(feature) <= 2 * forest.sample
        assert all(f < 0 or (low[i] > i and high[i] > i) for i, f in enumerate(feature))
    got = {r["id"]: r[isolation.SCORE] for r in isolation.score(df, forest).collect()}
    usual = isolation.usual_steps(forest.sample)
    for name, *values in rows:
        row = [0.0 if v is None or v != v else v for v in values]
        mean = sum(plain_steps(t, row) for t in forest.trees) / trees
        assert abs(got[name] - 2 ** (-mean / usual)) < 1e-12 and 0 < got[name] <= 1
    if trees == 50:
        assert max(got, key=got.get) == "odd" and got["odd"] > 0.6


def test_forest_is_drawn_alike_and_bounded(spark):
    rows, df = accounts(spark)
    again = spark.createDataFrame(rows[::-1], df.schema).repartition(7)
    assert isolation.fit(df, ["x", "z"], 10, 16).trees == isolation.fit(again, ["x", "z"], 10, 16).trees
    assert len(isolation.sampled(df, ["x"], 5, 8)) == 40
    none = df.filter("false")
    assert isolation.score(none, isolation.fit(none, ["x"])).count() == 0
    alike = isolation.score(df, isolation.fit(df, ["same"], 5, 16)).select(isolation.SCORE).distinct().collect()
    assert len(alike) == 1


def test_rows_go_down_the_trees_in_batches(spark):
    """Extreme values go as in the walk, and no row is interpreted node by node."""
    ends = [float("inf"), float("-inf"), -0.0, 0.0, 5e-324, -1.7e308]
    rows = [(f"e{i}", x, y) for i, (x, y) in enumerate((x, y) for x in ends for y in ends)] + [(f"a{i}", float(i % 97), float(i % 89)) for i in range(25_000)]
    df = spark.createDataFrame(rows, "id string, x double, y double").repartition(1)
    forest = isolation.fit(df.filter("id LIKE 'a%'"), ["x", "y"], 20, 128)
    scored = isolation.score(df, forest)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    got = {r["id"]: r[isolation.SCORE] for r in scored.collect()}
    usual = isolation.usual_steps(forest.sample)
    assert len(got) == len(rows)
    for name, *row in rows[:200]:
        assert abs(got[name] - 2 ** (-sum(plain_steps(t, row) for t in forest.trees) / 20 / usual)) < 1e-12


def plain_decayed(rows, half_life):
    epoch = half_life * temporal.EPOCH
    out = {}
    for seq, sender, amount, ts in rows:
        t = (ts - datetime(1970, 1, 1)).total_seconds()
        prior = []
        for s2, sender2, a2, ts2 in rows:
            t2 = (ts2 - datetime(1970, 1, 1)).total_seconds()
            if sender2 == sender and (ts2, s2) < (ts, seq) and t2 // epoch >= t // epoch - 2:
                prior.append((2 ** (-(t - t2) / half_life), a2))
        weight = sum(w for w, _ in prior)
        mean = sum(w * a for w, a in prior) / weight if prior else None
        if len(prior) < 2:
            std = None
        elif len({a for _, a in prior}) == 1:
            std = 0.0
        else:
            std = (sum(w * (a - mean) ** 2 for w, a in prior) / weight) ** 0.5
            extent = max(a for _, a in prior) - min(a for _, a in prior)
            std = 0.0 if std < temporal.LEAST_SPREAD * extent else std
        out[seq] = (weight, mean, std, (amount - mean) / std if std else None)
    return out


@pytest.mark.parametrize("half_life,spread", [(3600, 86_400), (60, 86_400), (10, 20_000), (86_400, 3600)])
def test_decayed_baseline(spark, half_life, spread):
    """Histories within an epoch, over several, and with gaps that make a sender forget."""
    rnd = random.Random(half_life)
    rows = []
    for i in range(260):
        sender = "hub" if rnd.random() < 0.4 else rnd.choice("abcd")
        amount = 5.0 if sender == "d" else 1e6 + rnd.randint(0, 400) / 8
        rows.append((i, sender, amount, START + timedelta(seconds=rnd.randint(0, spread))))
    rows.append((300, "d", 9.0, rows[-1][3]))
    df = spark.createDataFrame(rows, "seq long, sender string, amount double, ts timestamp").repartition(5)
    want = plain_decayed(rows, half_life)
    for r in temporal.decayed_deviation(df, half_life).collect():
        got = (r["prior_weight"], r["decayed_mean"], r["decayed_std"], r["decayed_z"])
        for a, b in zip(got, want[r["seq"]], strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-6 * max(1, abs(b))), (r, want[r["seq"]])


def play(spark, rows, slices, late="1 hour"):
    root = scratch_path(spark, "velocity")
    landing, out, state, dropped = f"{root}/landing", f"{root}/out", f"{root}/state", []

    def start():
        query = live.to_table(live.live_transaction_velocity(replay.open_stream(spark, landing, STREAM), 3600, late), out, state)
        query.awaitTermination()
        dropped.append(live.late_rows(query))
        return query

    replay.drive(slices, landing, start)
    found = spark.read.parquet(out).filter(F.col("sender") != CLOSING)
    return {r["seq"]: (r["velocity_count"], r["velocity_amount"]) for r in found.collect()}, sum(dropped)


def test_velocity_of_transactions_on_a_stream(spark):
    pairs = random_pairs(6, 80, 4, hub_share=0.3)
    rnd = random.Random(2)
    data = [(i, s, r, a, START + timedelta(seconds=300 * i + rnd.randint(-900, 900)), "P2P", 0) for i, (s, r, a) in enumerate(pairs)]
    data.append((500, *data[10][1:]))  # the same second twice
    rows = spark.createDataFrame(data, STREAM)
    last = rows.agg(F.max("ts").alias("ts"))
    got, dropped = play(spark, rows, closing_slices(replay.ranked_slices(rows, [F.col("seq") % 100], 3), last))
    batch = {r["seq"]: (r["velocity_count"], r["velocity_amount"]) for r in temporal.velocity(rows).collect()}
    assert got == batch and dropped == 0
    # A transaction three days late is dropped on both sides of the join, and said to be.
    late = spark.createDataFrame([(900, "hub", "n1", 1.0, START - timedelta(days=3), "P2P", 0)], STREAM)
    parts = [*replay.ranked_slices(rows, [F.col("seq") % 100], 2), late]
    got, dropped = play(spark, rows, closing_slices(iter(parts), last))
    assert got == batch and dropped >= 1


def test_repeated_and_empty_values_on_a_stream(spark):
    """A transaction that comes twice, without key, amount, sender or time; and no row of state for each pair of rows."""
    data = [(1, "a", 0, 2.5), (1, "a", 0, 2.5), (2, "a", 3600, 1.0), (3, "a", 3601, 4.0), (None, "a", 7300, None), (5, "b", -1, None),
            (6, None, 5, 1.0), (7, "a", None, 1.0), (8, "c", 7199, 1.0), (9, "c", 10799, 2.0)]
    rows = spark.createDataFrame([(i, s, "r", a, None if t is None else START + timedelta(seconds=t), "P2P", 0) for i, s, t, a in data], STREAM)
    got, dropped = play(spark, rows, closing_slices(iter([rows]), rows.agg(F.max("ts").alias("ts"))))
    assert dropped == 0
    assert got == {1: (4, 10.0), 2: (3, 6.0), 3: (2, 5.0), None: (1, None), 5: (1, None), 8: (1, 1.0), 9: (2, 3.0)}
    landing = scratch_path(spark, "landing")
    rows.write.parquet(landing)
    plan = live.live_transaction_velocity(replay.open_stream(spark, landing, STREAM))._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan
