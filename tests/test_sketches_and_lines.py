"""Daily sketches, lines that don't fit their header, F1 from counts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerweb.operators import ingest, model, reports, sketches
from ledgerweb.sources import readers


def payments(spark, n, accounts, days, seed=1):
    rnd = random.Random(seed)
    rows = [(f"a{rnd.randrange(accounts)}", f"b{rnd.randrange(accounts)}", rnd.randrange(1, 800) / 8, datetime(2024, 1, 1) + timedelta(days=rnd.randrange(days)), None) for _ in range(n)]
    rows += [(None, "b1", 1.0, datetime(2024, 1, 2), None), ("a1", None, 2.0, None, None)]
    return rows, spark.createDataFrame(rows, "sender string, receiver string, amount double, ts timestamp, type string")


@pytest.mark.parametrize("within,accounts", [(0.01, 3000), (0.05, 300)])
def test_merged_and_trailing(spark, within, accounts):
    rows, tx = payments(spark, 6000, accounts, 20)
    days = sketches.daily(tx, within).persist()
    one = sketches.merged(days).first()
    for name, want in (("senders", {r[0] for r in rows}), ("receivers", {r[1] for r in rows}), ("accounts", {x for r in rows for x in r[:2]})):
        assert abs(one[name] / len(want - {None}) - 1) <= within
    assert one["tx_count"] == len(rows) and one["amount"] == sum(r[2] for r in rows)
    for r in sketches.trailing(days, 5).collect():
        own = [x for x in rows if x[3] is not None and timedelta(0) <= datetime.combine(r["day"], datetime.min.time()) - x[3] < timedelta(days=5)]
        assert r["tx_count"] == len(own) and r["amount"] == sum(x[2] for x in own)
        assert abs(r["accounts"] / len({a for x in own for a in x[:2]} - {None}) - 1) <= within


def test_sketch_sizes(spark):
    assert [sketches.size_for(w) for w in (1.0, 0.05, 0.01)] == [4, 12, 17]
    with pytest.raises(ValueError):
        sketches.size_for(1e-6)
    assert sketches.daily(payments(spark, 0, 1, 1)[1].filter("false")).count() == 0


def test_broken_lines(spark, tmp_path):
    lines = ["sender,receiver,amount,type", "a,b,10,P2P", "a,b", "a,b,10,P2P,more", '"x,y",b,10,P2P', ",b,10,P2P", "a,b,ten,P2P", "a,b,0,P2P", "a,b,10,gift"]
    (tmp_path / "upload.csv").write_text("\n".join(lines) + "\n")
    valid, rejected = ingest.validate(ingest.coerce_upload(readers.read_upload(spark, str(tmp_path), line="line"), line="line"), line="line")
    assert sorted((r["sender"], r["amount"], r["line"]) for r in valid.collect()) == [("a", 10.0, None), ("x,y", 10.0, None)]
    assert sorted((r["reason"], r["line"]) for r in rejected.collect() if r["line"]) == [("broken line", "a,b"), ("broken line", "a,b,10,P2P,more")]
    assert sorted(r["reason"] for r in rejected.collect()) == ["amount below minimum", "amount missing", "broken line", "broken line", "sender missing", "unknown type"]
    plain = ingest.coerce_upload(readers.read_upload(spark, str(tmp_path)))
    assert "line" not in plain.columns and plain.count() == 8


@pytest.mark.parametrize("pairs", [[(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)], [(1, 0), (1, 0)], [(0, 0)], [(1, 1), (0, 1), (0, 1)]])
def test_f1_from_counts(spark, pairs):
    judged = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    assert abs(model.weighted_f1(judged).first()[0] - model.multiclass_metric(judged)) < 1e-12


def test_approximate_accounts_by_type(spark):
    _, tx = payments(spark, 500, 40, 3)
    typed = tx.withColumn("type", F.when(F.col("amount") > 50, "big").otherwise("small"))
    exact = {r["type"]: r["n"] for r in typed.select("type", F.explode(F.array("sender", "receiver")).alias("id")).groupBy("type").agg(F.count_distinct("id").alias("n")).collect()}
    assert {r["type"]: r["accounts"] for r in reports.approximate_accounts(typed, 0.01, ["type"]).collect()} == exact
