import random
import statistics

import pytest

from ledgerweb.functions.ordered import global_rank, prior_moments, running
from pyspark.sql import functions as F


def test_running_over_a_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(30)}", i, rnd.randrange(100)) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, t int, v long").repartition(5)
    got = running(df, ["k"], [F.col("t")], sums={"before": F.col("v")}, maxes={"high": F.col("v")})
    seen, expected = {}, {}
    for k, t, v in rows:
        past = seen.setdefault(k, [])
        expected[t] = (sum(past), max(past) if past else None)
        past.append(v)
    assert {r["t"]: (r["before"], r["high"]) for r in got.collect()} == expected


def test_running_inclusive_and_descending(spark):
    df = spark.range(100).withColumn("one", F.lit(1))
    got = running(df, [], [F.col("id").desc()], sums={"n": F.col("one")}, inclusive=True)
    assert all(r["n"] == 100 - r["id"] for r in got.collect())


def test_rank(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("s"), "id")
    ranked = global_rank(df, [F.desc("s"), F.col("id")]).collect()
    expected = sorted(((r["s"], r["id"]) for r in ranked), key=lambda x: (-x[0], x[1]))
    assert [(r["s"], r["id"]) for r in sorted(ranked, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in ranked) == list(range(1, 501))


def test_prior_moments_of_large_close_values(spark):
    rnd = random.Random(3)
    rows = [("even", i, 1e7 + i % 2) for i in range(200)] + [("alike", i, 0.1) for i in range(90)]
    rows += [(f"k{rnd.randrange(5)}", 1000 + i, rnd.uniform(-5, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(6)
    got = {(r["k"], r["t"]): r for r in prior_moments(df, ["k"], [F.col("t")], "v").collect()}
    seen = {}
    for k, t, v in rows:
        past, r = seen.setdefault(k, []), got[k, t]
        assert r["n"] == len(past) and (r["low"], r["high"]) == ((min(past), max(past)) if past else (None, None))
        if past:
            assert r["mean"] == pytest.approx(statistics.fmean(past), rel=1e-12)
            assert r["m2"] == pytest.approx(statistics.pvariance(past) * len(past), rel=1e-9, abs=1e-12)
        past.append(v)
    assert len(got) == len(rows)
