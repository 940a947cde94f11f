"""Nearest rows and synthetic rows against all pairs."""

import random

import pytest

from ledgerweb.operators import neighbors


def plain(rows, k):
    columns = list(zip(*[[0.0 if v is None else float(v) for v in r[1:]] for r in rows], strict=True))
    scaled = list(zip(*[[(v - min(c)) / (max(c) - min(c)) if max(c) > min(c) else 0.0 for v in c] for c in columns], strict=True))
    out = {}
    for i, (name, *_) in enumerate(rows):
        near = sorted((sum((a - b) * (a - b) for a, b in zip(scaled[i], scaled[j], strict=True)), rows[j][0]) for j in range(len(rows)) if j != i)
        out[name] = [(n, d ** 0.5) for d, n in near[:k]]
    return out


def messy(seed, n=300):
    """Clusters, heavy tails, one value a third of all rows have, a column without spread, nulls, far-off rows."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.33:
            x = (1.0, 2.0, 5.0)
        elif kind < 0.6:
            x = (rnd.randint(0, 5), rnd.randint(0, 3), 5.0 + rnd.randint(0, 1))
        else:
            x = (rnd.paretovariate(0.5), rnd.gauss(0, 1), 5.0)
        rows.append((f"p{i:03d}", *map(float, x), 7.0))
    return rows + [("far", 1e9, -50.0, None, 7.0), ("farther", 2e9, 90.0, 5.0, 7.0)]


SCHEMA = "id string, a double, b double, c double, same double"


@pytest.mark.parametrize("seed,k", [(1, 5), (2, 1), (3, 12)])
def test_nearest(spark, seed, k):
    rows = messy(seed)
    want = plain(rows, k)
    got = {}
    for r in neighbors.nearest(spark.createDataFrame(rows, SCHEMA).repartition(6), ["a", "b", "c", "same"], k).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbor"], r["distance"]))
        assert r["rank"] == len(got[r["id"]])
    assert got.keys() == want.keys()
    for name, near in want.items():
        assert [n for n, _ in got[name]] == [n for n, _ in near] and all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got[name], near, strict=True)), name


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_rows(spark, n):
    rows = [(f"p{i}", float(i), 0.0) for i in range(n)]
    found = neighbors.nearest(spark.createDataFrame(rows, "id string, a double, b double"), ["a", "b"], 3).collect()
    assert len(found) == n * min(3, max(n - 1, 0))


def test_synthetic_rows_lie_between_neighbours(spark):
    rows = [(*r, int(i % 4 == 0)) for i, r in enumerate(messy(4))]
    positives = [r[:-1] for r in rows if r[-1]]
    near = plain([(r[0], r[1], r[2]) for r in positives], 3)
    by_id = {r[0]: r for r in positives}
    made = neighbors.smote(spark.createDataFrame(rows, SCHEMA + ", label int"), ["a", "b"], k=3, per_row=4).collect()
    assert len(made) == 4 * len(positives) and len({r["id"] for r in made}) == len(made)
    chosen = set()
    for r in made:
        own = by_id[r["id"].split("#")[0]]
        fits = []
        for rank, (name, _) in enumerate(near[own[0]]):
            other = by_id[name]
            inside = all(min(a, b) - 1e-6 <= v <= max(a, b) + 1e-6 for v, a, b in ((r["a"], own[1], other[1]), (r["b"], own[2], other[2])))
            cross = abs((r["a"] - own[1]) * (other[2] - own[2]) - (r["b"] - own[2]) * (other[1] - own[1]))
            if inside and cross <= 1e-6 * max(1.0, abs(other[1] - own[1])):
                fits.append(rank)
        assert fits
        chosen |= set(fits) if len(fits) == 1 else set()
    assert chosen == {0, 1, 2}
    alone = neighbors.smote(spark.createDataFrame(rows[:1], SCHEMA + ", label int"), ["a", "b"])
    assert alone.count() == 0


def test_rows_are_worked_out_once(spark, monkeypatch):
    """The extent and the scaled rows both come from stored rows, not from what leads to them."""
    asked, plain_scaled = [], neighbors.scaled
    monkeypatch.setattr(neighbors, "scaled", lambda df, *rest: asked.append(df) or plain_scaled(df, *rest))
    found = neighbors.nearest(spark.createDataFrame([("p", 0.0, 1.0), ("q", 1.0, 1.0)], "id string, a double, b double"), ["a", "b", "a"], 1)
    assert sorted((r["id"], r["neighbor"]) for r in found.collect()) == [("p", "q"), ("q", "p")]
    assert all("/rows-" in f for f in asked[0].inputFiles()) and asked[0].inputFiles()
