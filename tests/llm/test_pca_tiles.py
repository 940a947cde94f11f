"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweb.llm.pca_tiles import compare, forest, linked_pairs, near_duplicates
from tests.llm.conftest import as_rows

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def plain(rows, threshold):
    fine = []
    for at, (_, x, label) in enumerate(rows):
        if label is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x):
            v = np.array(x, dtype=np.float64)
            fine.append((at, label, v / np.abs(v).max()))
    links = {i: set() for i in range(len(rows))}
    for i, (a, la, x) in enumerate(fine):
        for b, lb, y in fine[:i]:
            if la == lb and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out, seen = [], {}
    for i in range(len(rows)):
        if i not in seen:
            queue, found = [i], {i}
            while queue:
                for j in links[queue.pop()] - found:
                    found.add(j)
                    queue.append(j)
            ids = [rows[j][0] for j in found if rows[j][0] is not None]
            seen |= dict.fromkeys(found, min(ids) if ids else None)
        out.append((rows[i][0], len(links[i]), seen[i], rows[i][0] == seen[i]))
    return sorted(out, key=repr)


def messy(seed=2, size=24):
    """Clusters, chains, copies, all kinds of vectors that take no part, repeated ids and other lengths."""
    rng = np.random.default_rng(seed)
    rows = []

    def add(x, label):
        rows.append((len(rows) * 7 % 1009, None if x is None else [None if v is None else float(np.float32(v)) for v in x], label))

    spectrum = 1 / np.arange(1, size + 1)
    for _ in range(150):
        add(rng.normal(size=size) * spectrum, int(rng.integers(0, 4)))
    for label in (0, 0, 1):
        centre = rng.normal(size=size)
        for _ in range(60):
            add(centre + rng.normal(size=size) * rng.choice([0.02, 0.1, 0.3]), label)
    step = rng.normal(size=size)
    for _ in range(30):
        step = step + 0.25 * rng.normal(size=size)
        add(step, 2)
    for label in (0, 1):
        for scale in (1, 1, 1, 2, 1e-30, -1, 1e30):
            add(np.ones(size) * scale, label)
    add([0.0] * size, 0)
    add([-0.0] * size, 0)
    add([0.0] * (size - 1) + [1e-40], 0)
    add([float("nan")] + [1.0] * (size - 1), 0)
    add([float("inf")] + [1.0] * (size - 1), 0)
    add([None] + [1.0] * (size - 1), 0)
    add([], 0)
    add(None, 0)
    for label in (0, 3):
        add([1.0], label)
        add([-1.0], label)
        add([2.0], label)
        add([1.0, 1.0], label)
        add([1.0, 0.9], label)
    rows += [rows[3], rows[3], (rows[4][0], rows[200][1], 0), (None, rows[160][1], 0), (None, rng.normal(size=size).tolist(), 3), (None, None, None)]
    rows += [(r[0] + 5000, r[1], None) for r in rows[:5]]
    return [(i, None if x is None else [None if v is None else float(np.float32(v)) for v in x], label) for i, x, label in rows]


@pytest.mark.parametrize("tile,threshold", [(2048, 0.93), (16, 0.93), (7, 0.99), (33, 0.5)])
def test_against_all_pairs(spark, tile, threshold):
    rows = messy()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    clashing = frame.select("*", *[F.lit(1).alias(c) for c in ("row", "uid", "size", "vec", "members", "block", "other", "a", "b", "n", "fine", "root")])
    assert as_rows(near_duplicates(clashing, threshold, tile), *COLUMNS) == plain(rows, threshold)


def test_large_and_small_components(spark):
    rows = [(i, [10.0 ** e * (1 + i % 3), 10.0 ** e], "x") for i, e in enumerate([300, -300, 0, 200, 300, -320, 308])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert as_rows(near_duplicates(frame), *COLUMNS) == plain(rows, 0.93)


def test_none(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert as_rows(near_duplicates(spark.createDataFrame([(4, [1.0, 2.0], None), (None, None, 1)], SCHEMA)), *COLUMNS) == [
        (4, 0, 4, True), (None, 0, None, True)]
    with pytest.raises(ValueError):
        near_duplicates(spark.createDataFrame([], SCHEMA), 0.0)


@pytest.mark.parametrize("spread", [0.02, 0.2, 1.0])
def test_dense_and_sparse_tiles(spread):
    """A tile of copies is accumulated whole, one of strangers pair by pair; both are exact, and so is the threshold."""
    rng = np.random.default_rng(int(100 * spread))
    a, b = (rng.normal(size=32) + spread * rng.normal(size=(n, 32)) * 3 for n in (90, 70))
    a[3], b[5] = [1.0] + [0.0] * 31, [0.6, 0.8] + [0.0] * 30  # a cosine of exactly 0.6
    basis = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b)]
    for threshold in (0.6, 0.93):
        want = set(zip(*np.nonzero(unit[0] @ unit[1].T >= threshold)))
        assert set(zip(*linked_pairs(a, b, basis, threshold, False))) == want == set(zip(*linked_pairs(a, b, None, threshold, False)))
        own = set(zip(*np.nonzero(np.triu(unit[0] @ unit[0].T >= threshold, 1))))
        assert set(zip(*linked_pairs(a, a, basis, threshold, True))) == own


def test_forest():
    rng = np.random.default_rng(1)
    for count, links in ((1, 0), (50, 20), (50, 60), (400, 399)):
        i, j = rng.integers(0, count, links), rng.integers(0, count, links)
        if links == 399:
            i = rng.permutation(400)  # one path in any order
            i, j = i[:-1], i[1:]
        top = list(range(count))
        for _ in range(count):
            for a, b in zip(i, j):
                top[a] = top[b] = min(top[a], top[b])
        node, low = forest(np.asarray(i), np.asarray(j), count)
        assert dict(zip(node.tolist(), low.tolist())) == {n: t for n, t in enumerate(top) if n != t}


def test_rows_of_a_dense_tile():
    import pyarrow as pa

    n, size = 200, 8
    x = np.ones((n, size)) + np.random.default_rng(0).normal(size=(n, size)) * 1e-3
    data = np.arange(n).tobytes() + np.ones(n, dtype=np.int64).tobytes() + x.tobytes()
    found = compare(pa.table({"block": [0], "size": [size], "n": [n], "data": [data]}), {}, 0.93).to_pylist()
    assert len(found) == n + n - 1 and all(r["n"] == n - 1 for r in found if r["b"] is None)
