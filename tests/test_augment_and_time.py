import datetime as dt
from collections import defaultdict

import pytest

from ledgerweb.operators import augment, features, graph, rings, temporal
from ledgerweb.plans import medallion
from ledgerweb.sources.readers import read_table
from pyspark.sql import functions as F
from tests.helpers import brute_cycles, random_pairs, tx

START = dt.datetime(2024, 1, 1)


def timed(spark, rows):
    """(sender, seconds, amount) → transactions with a sequence number."""
    return spark.createDataFrame(
        [(i, s, "r", float(a), START + dt.timedelta(seconds=t)) for i, (s, t, a) in enumerate(rows)],
        "seq long, sender string, receiver string, amount double, ts timestamp")


def test_scale(spark):
    base = timed(spark, [("a", 0, 100), ("b", 60, 50)]).withColumn("transaction_date", F.to_date("ts"))
    rows = augment.scale(base, copies=3).collect()
    again = augment.scale(base.repartition(5), copies=3).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert len(rows) == 6
    for r in rows:
        assert abs(r["amount"] - (100 if r["sender"] == "a" else 50)) <= 0.05 * 100
        assert r["transaction_date"] == r["ts"].date()
    assert {r["ts"].day for r in rows} == {1, 2, 3}


def test_ring_rows(spark):
    base = tx(spark, random_pairs(50, 300, 4))
    drawn = augment.ring_rows(base, n_rings=20, rewire=0.0).collect()
    per_ring, noise = defaultdict(list), defaultdict(int)
    for r in drawn:
        assert r["ts"] >= START and r["ts"] < START + dt.timedelta(hours=1)
        if r["kind"] == "ring":
            per_ring[r["ring"]].append(r)
            assert r["is_fraud"] == 1 and 500 <= r["amount"] < 10000
        else:
            noise[r["ring"]] += 1
            assert r["is_fraud"] == 0 and 100 <= r["amount"] < 5000
    assert len(per_ring) == 20 and all(5 <= n <= 8 for n in noise.values())
    for steps in per_ring.values():
        steps.sort(key=lambda r: r["step"])
        assert 5 <= len(steps) <= 10 and len({r["sender"] for r in steps}) == len(steps)
        assert [r["receiver"] for r in steps] == [r["sender"] for r in steps[1:] + steps[:1]]
    joined = augment.inject_rings(base, n_rings=20, rewire=0.0)
    assert joined.count() == 300 + len(drawn) and joined.columns[-1] == "is_fraud"


def test_rings_need_accounts(spark):
    assert augment.ring_rows(tx(spark, [])).count() == 0
    few = augment.ring_rows(tx(spark, [("a", "b")]), n_rings=2, rewire=0.0).filter("kind = 'ring'").collect()
    assert {r["sender"] for r in few} == {"a", "b"} and len(few) == 4


@pytest.mark.parametrize("lengths", [(3,), (3, 4, 5), (5,)])
def test_cycles_against_brute_force(spark, lengths):
    pairs = random_pairs(14, 45, 11, 0.2)
    found = rings.cycles(graph.edges(tx(spark, pairs)), lengths).collect()
    assert {r["ring"] for r in found} == brute_cycles(pairs, lengths)
    assert len(found) == len({r["ring"] for r in found})
    assert all(r["length"] == len(r["members"]) for r in found)


def test_no_cycles(spark):
    assert rings.cycles(graph.edges(tx(spark, [("a", "b"), ("b", "c"), ("b", "a")]))).count() == 0
    with pytest.raises(ValueError):
        rings.cycles(graph.edges(tx(spark, [("a", "b")])), (2,))


def test_cycles_of_other_lengths_are_refused(spark):
    with pytest.raises(ValueError):
        rings.cycles(graph.edges(tx(spark, [("a", "b")])), (6,))


def test_ring_recall(spark):
    base = tx(spark, [(f"c{i}", f"s{i % 7}") for i in range(60)])
    drawn = augment.ring_rows(base, n_rings=12, size=(3, 5), rewire=0.1, noise=(1, 1)).cache()
    e = graph.edges(augment.append_rings(base, drawn))
    edges = {(r["src"], r["dst"]) for r in e.collect()}
    steps = defaultdict(list)
    for r in drawn.filter("kind = 'ring'").orderBy("ring", "step").collect():
        steps[r["ring"]].append(r)
    expected = defaultdict(lambda: [0, 0, 0])
    for own in steps.values():
        members = [r["sender"] for r in own]
        count = expected[len(members)]
        count[0] += 1
        count[1] += not any(r["rewired"] for r in own)
        count[2] += all(pair in edges for pair in zip(members, members[1:] + members[:1]))
    got = {r["ring_size"]: [r["rings"], r["whole"], r["found"]] for r in rings.ring_recall(drawn, e).collect()}
    assert got == expected
    assert sum(n[1] for n in got.values()) > 0


def test_rings_are_drawn_from_all_accounts(spark):
    base = tx(spark, [(f"c{i}", f"s{i}") for i in range(4000)])
    pool = graph.account_pool(base).collect()
    assert sorted(r["place"] for r in pool) == list(range(8000))
    drawn = augment.ring_rows(base, n_rings=400).select("sender").distinct().count()
    assert drawn > 2000


def test_velocity(spark):
    rows = [("a", t, 1) for t in (0, 10, 10, 3600, 3610, 3611, 9000)] + [("b", 3599, 5), ("b", 3600, 5)]
    got = {r["seq"]: (r["velocity_count"], r["velocity_amount"]) for r in temporal.velocity(timed(spark, rows)).collect()}
    for i, (s, t, _) in enumerate(rows):
        inside = [a for s2, t2, a in rows if s2 == s and t - 3600 <= t2 <= t]
        assert got[i] == (len(inside), float(sum(inside)))


def test_deviation(spark):
    rows = [("a", 1, 10), ("a", 2, 20), ("a", 3, 60), ("b", 1, 5), ("b", 2, 5), ("b", 3, 5), ("b", 4, 9)]
    got = {r["seq"]: r for r in temporal.amount_deviation(timed(spark, rows)).collect()}
    assert [got[i]["prior_count"] for i in range(7)] == [0, 1, 2, 0, 1, 2, 3]
    assert got[0]["prior_mean"] is None and got[1]["amount_z"] is None
    assert got[2]["prior_mean"] == 15 and abs(got[2]["amount_z"] - 45 / 50 ** 0.5) < 1e-9
    assert got[6]["prior_std"] == 0 and got[6]["amount_z"] is None


def test_deviation_of_large_close_amounts(spark):
    rows = [("a", i, 10_000_000 + i % 2) for i in range(201)]
    last = {r["seq"]: r for r in temporal.amount_deviation(timed(spark, rows)).collect()}[200]
    assert round(last["prior_std"], 5) == 0.50125 and abs(last["amount_z"]) == pytest.approx(0.5 / 0.501255, rel=1e-4)


def test_sessions(spark):
    day = 86400
    rows = [("a", 0, 1), ("a", 1000, 1), ("a", 5000, 1), ("a", day - 60, 1), ("a", day + 60, 1), ("a", day + 1859, 1),
            ("b", 0, 2)]
    got = [(r["sender"], r["tx_count"], (r["session_end"] - r["session_start"]).total_seconds())
           for r in temporal.sessions(timed(spark, rows), 1800).orderBy("sender", "session_start").collect()]
    assert got == [("a", 2, 2800.0), ("a", 1, 1800.0), ("a", 3, 60 + 1859 + 1800.0), ("b", 1, 1800.0)]


def test_session_border_is_the_same_within_and_across_days(spark):
    """Two rows exactly one gap apart: whatever Spark's session window decides also holds at midnight."""
    day = 86400
    within = temporal.sessions(timed(spark, [("a", 0, 1), ("a", 1800, 1)]), 1800).count()
    across = temporal.sessions(timed(spark, [("a", day - 900, 1), ("a", day + 900, 1)]), 1800).count()
    assert within == across


def test_windows(spark):
    rows = [("a", 0, 1), ("a", 1800, 2), ("a", 3600, 4)]
    hours = [(r["tx_count"], r["tx_amount"]) for r in
             temporal.window_totals(timed(spark, rows)).orderBy("window_start").collect()]
    assert hours == [(2, 3.0), (1, 4.0)]
    assert temporal.window_totals(timed(spark, rows), "1 hour", "30 minutes").count() == 4


def test_medallion(spark, tmp_path):
    pairs = random_pairs(60, 400, 9)
    raw = spark.createDataFrame(
        [(s, r, a, 3600 * i, 0) for i, (s, r, a) in enumerate(pairs)],
        "nameOrig string, nameDest string, amount double, step long, isFraud int")
    paths = medallion.run(spark, raw, str(tmp_path), copies=2, rings={"n_rings": 10})
    count = {n: read_table(spark, p).count() for n, p in paths.items()}
    assert count["transactions_bronze"] == count["transactions_silver"] == 400
    assert count["transactions_scaled"] == 800 and count["transactions_final"] > 850
    assert count["ml_features"] == count["nodes_table"]
    final = read_table(spark, paths["transactions_final"])
    assert features.labels(final).filter("label = 1").count() > 0
    assert 0 < count["fraud_predictions"] < count["nodes_table"]
