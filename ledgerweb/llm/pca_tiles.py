"""Near duplicates of embeddings by a tiled comparison that reads the principal components first.

Vectors are turned into the basis of their principal components, where the leading ones hold most of a vector's length. Vectors
with one label are sorted by the first component and cut into blocks; two blocks whose boxes lie too far apart are not compared. In
a tile, two blocks, the products of the leading components are accumulated; the rest can add at most the product of both
vectors' remaining lengths (Cauchy-Schwarz), so a pair is dropped once that can't lift its cosine to the threshold. Whoever
is left at the end comes within rounding of the threshold or above; the doubtful are computed again from the vectors as given.

Equal vectors are compared once. A tile returns how many vectors each of its own is linked with, and a spanning forest of the links:
rows in proportion to its vectors, however dense it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm.common import stored
from ledgerweb.llm.connected import roots

THRESHOLD = 0.93
TILE = 2048
BOX = 8  # leading components that a block's box is taken of
WIDEST = 2048  # components up to which the basis is fitted; beyond, they are read as they stand
SLACK = 1e-9  # far above the rounding of a product of unit vectors
PAIRS_AT_ONCE = 1 << 16
BLOCK_SCHEMA = "block long, label_key {0}, size int, n int, data binary, low array<double>, high array<double>"
FOUND_SCHEMA = "a long, b long, n long"
FOUND_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def unit_rows(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors scaled by powers of two (exactly, so that no square overflows), their lengths, and unit vectors."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1))
    even = np.ldexp(vectors, -exponents[:, None])
    lengths = np.sqrt(np.einsum("ij,ij->i", even, even))
    return even, lengths, even / lengths[:, None]


def stages(size: int) -> list[int]:
    """Where the accumulation stops to look at the bound: after an eighth of the components, a fourth, a half, all."""
    return sorted({max(1, size // 8), max(1, size // 4), max(1, size // 2), size})


def linked_pairs(a: np.ndarray, b: np.ndarray, basis: np.ndarray | None, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs with a cosine of `threshold` or more; each once, and none with itself, where both blocks are the same."""
    (even_a, length_a, unit_a), (even_b, length_b, unit_b) = unit_rows(a), unit_rows(b)
    if basis is not None:
        unit_a, unit_b = unit_a @ basis, unit_b @ basis
    cuts = stages(a.shape[1])

    def rests(unit: np.ndarray) -> dict[int, np.ndarray]:
        return {c: np.sqrt(np.einsum("ij,ij->i", unit[:, c:], unit[:, c:])) for c in cuts}

    rest_a, rest_b = rests(unit_a), rests(unit_b)
    products, done = np.zeros((len(a), len(b))), 0
    i = j = None
    for cut in cuts:
        if i is None:
            products += unit_a[:, done:cut] @ unit_b[:, done:cut].T
            can = products + rest_a[cut][:, None] * rest_b[cut][None, :] >= threshold - SLACK
            if same:
                can = np.triu(can, 1)
            # From here on only the pairs left are accumulated, where few are.
            if cut == cuts[-1] or np.count_nonzero(can) * 16 < can.size:
                i, j = np.nonzero(can)
                value = products[i, j]
                del products, can
        else:
            for at in range(0, len(i), PAIRS_AT_ONCE):
                part = slice(at, at + PAIRS_AT_ONCE)
                value[part] += np.einsum("ij,ij->i", unit_a[i[part], done:cut], unit_b[j[part], done:cut])
            can = value + rest_a[cut][i] * rest_b[cut][j] >= threshold - SLACK
            i, j, value = i[can], j[can], value[can]
        done = cut
    linked = value > threshold + SLACK
    for at in range(0, len(doubtful := np.flatnonzero(~linked)), PAIRS_AT_ONCE):
        p = doubtful[at:at + PAIRS_AT_ONCE]
        linked[p] = np.einsum("ij,ij->i", even_a[i[p]], even_b[j[p]]) / (length_a[i[p]] * length_b[j[p]]) >= threshold
    return i[linked], j[linked]


def forest(i: np.ndarray, j: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) for the nodes of a graph that aren't that smallest one themselves."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            nodes = np.flatnonzero(label != np.arange(count))
            return nodes, label[nodes]
        label = new


def _unpacked(data: bytes, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(data, np.int64, 2 * n)
    return ids[:n], ids[n:], np.frombuffer(data, np.float64, n * size, 16 * n).reshape(n, size)


def compare(tile: pa.Table, basis: dict[int, np.ndarray], threshold: float) -> pa.Table:
    """Of the one or two blocks of a tile: (a, null, n), the n vectors that a is linked with, and (a, b, null), links that connect alike."""
    rows = tile.select(["block", "size", "n", "data"]).sort_by("block").to_pylist()
    first, second = rows[0], rows[-1]
    size, same = first["size"], len(rows) == 1
    ids_a, many_a, a = _unpacked(first["data"], first["n"], size)
    ids_b, many_b, b = _unpacked(second["data"], second["n"], size)
    i, j = linked_pairs(a, b, basis.get(size), threshold, same)
    linked_a, linked_b = np.bincount(i, weights=many_b[j], minlength=len(a)), np.bincount(j, weights=many_a[i], minlength=len(b))
    counts = [(ids_a, linked_a + linked_b)] if same else [(ids_a, linked_a), (ids_b, linked_b)]
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    node, top = forest(i, j if same else j + len(a), len(ids))
    owners = np.concatenate([own[n > 0] for own, n in counts])
    numbers = np.concatenate([n[n > 0] for _, n in counts]).astype(np.int64)
    return pa.Table.from_arrays([
        pa.array(np.concatenate([owners, ids[node]])),
        pa.array(np.concatenate([np.zeros(len(owners), np.int64), ids[top]]), mask=np.arange(len(owners) + len(node)) < len(owners)),
        pa.array(np.concatenate([numbers, np.zeros(len(node), np.int64)]), mask=np.arange(len(owners) + len(node)) >= len(owners)),
    ], schema=FOUND_ARROW)


def fitted_basis(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal components, leading first, for the most frequent number of components. Any other is read as it stands."""
    most = classes.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if most is None or most["count"] < 2 or not 1 < most["size"] <= WIDEST:
        return {}
    size = int(most["size"])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = unit_rows(batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, size))[2] if batch.num_rows else np.zeros((0, size))
            ends = np.arange(0, unit.size + 1, size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, unit.reshape(-1))], names=["unit"])

    alike = classes.filter(F.col("size") == size).select("vec").mapInArrow(units, "unit array<double>")
    fitted = PCA(k=size, inputCol="unit", outputCol="turned").fit(alike.select(array_to_vector("unit").alias("unit"))).pc.toArray()
    # Products stay what they are only in an orthonormal basis; data without spread may not give one.
    fine = np.isfinite(fitted).all() and np.allclose(fitted.T @ fitted, np.eye(len(fitted)), atol=1e-11, rtol=0)
    return {size: np.ascontiguousarray(fitted)} if fine else {}


def _packed(classes: DataFrame, basis: dict[int, np.ndarray], tile: int) -> DataFrame:
    """Stored blocks of at most `tile` vectors of one label and size that stand next to each other by the first component."""
    kind = classes.schema["label_key"].dataType.simpleString()
    fields = ["uid", "members", "label_key", "size", "vec"]

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = np.zeros((batch.num_rows, BOX))
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                unit = unit_rows(batch.column("vec").take(pa.array(at)).flatten().to_numpy().reshape(len(at), size))[2]
                unit = unit @ basis[size][:, :BOX] if size in basis else unit[:, :BOX]
                lead[at, :unit.shape[1]] = unit
            boxes = pa.ListArray.from_arrays(np.arange(0, BOX * batch.num_rows + 1, BOX, dtype=np.int32), lead.reshape(-1))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), pa.array(lead[:, 0]), boxes], names=[*fields, "first", "lead"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in _runs(batches, tile):
            lead = np.array(rows.column("lead").to_pylist())
            data = b"".join(rows.column(c).combine_chunks().to_numpy().tobytes() for c in ("uid", "members"))
            data += pa.compute.list_flatten(rows.column("vec")).to_numpy().tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array([number]), rows.column("label_key")[:1].combine_chunks(), pa.array([rows.column("size")[0].as_py()], pa.int32()),
                pa.array([rows.num_rows], pa.int32()), pa.array([data], pa.binary()),
                pa.array([lead.min(axis=0).tolist()], pa.list_(pa.float64())), pa.array([lead.max(axis=0).tolist()], pa.list_(pa.float64())),
            ], names=["block", "label_key", "size", "n", "data", "low", "high"])
            number += 1

    leading = stored(classes.select(*fields).mapInArrow(
        turned, f"uid long, members long, label_key {kind}, size int, vec array<double>, first double, lead array<double>"), "leading")
    parts = max(1, -(-leading.count() // tile))
    dealt = leading.repartitionByRange(parts, "label_key", "size", "first", "uid").sortWithinPartitions("label_key", "size", "first", "uid")
    return stored(dealt.mapInArrow(packed, BLOCK_SCHEMA.format(kind)), "vector-blocks")


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Runs of rows with one label and size, of at most `most` rows."""
    held, key, count = [], None, 0
    for batch in batches:
        at = 0
        labels, sizes = batch.column("label_key").to_pylist(), batch.column("size").to_pylist()
        own = list(zip(labels, sizes, strict=True))
        while at < batch.num_rows:
            if held and (own[at] != key or count == most):
                yield pa.Table.from_batches(held)
                held, count = [], 0
            key, to = own[at], at
            while to < batch.num_rows and own[to] == key and count + to - at < most:
                to += 1
            held.append(batch.slice(at, to - at))
            count += to - at
            at = to
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """`vec_id, n_links, component_id, kept` for every row of `vectors(vec_id, embedding, label)`.

    Two rows with equal labels are linked where their vectors' cosine is `threshold` or more (above 0). `n_links` counts the other rows that
    a row is linked with, `component_id` is the smallest vec_id that links reach, the row's own included, and `kept` marks rows that bear it.
    A vector that is null, empty, all zeros, or holds a null or non-finite component, and one without a label, is linked
    with nothing, and so are vectors of different lengths with each other. Repeated rows and ids are rows of their own; a
    null vec_id counts as the largest. Other columns are ignored; no vectors give no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold has to lie above 0 and not above 1")
    x = F.col("embedding").cast("array<double>")
    fine = F.col("label").isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = stored(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label_key"),
        x.alias("vec"), F.coalesce(fine, F.lit(False)).alias("fine")), "vectors")
    taking = rows.filter("fine")
    classes = stored(
        taking.groupBy("label_key", "vec").agg(F.min("row").alias("uid"), F.count(F.lit(1)).alias("members"), F.min("vec_id").alias("least"))
        .withColumn("size", F.size("vec")), "classes")
    basis = fitted_basis(classes)
    packed = _packed(classes, basis, tile)
    boxes = packed.select("block", "label_key", "size", "low", "high")
    gaps = F.zip_with(F.arrays_zip(F.col("low").alias("low"), F.col("high").alias("high")), F.arrays_zip(F.col("other_low").alias("low"), F.col("other_high").alias("high")),
                      lambda p, q: F.greatest(p["low"] - q["high"], q["low"] - p["high"], F.lit(0.0)))
    # Unit vectors of a cosine c lie sqrt(2 - 2c) apart.
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= 2 - 2 * threshold + SLACK
    tiles = stored(
        boxes.join(boxes.select(F.col("block").alias("other"), "label_key", "size", F.col("low").alias("other_low"), F.col("high").alias("other_high")),
                   ["label_key", "size"]).filter((F.col("block") <= F.col("other")) & near).select("block", "other"), "tiles")
    sides = tiles.select(F.col("block").alias("one"), "other", F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    found = stored(
        sides.join(packed.select("block", "size", "n", "data"), "block").groupBy("one", "other")
        .applyInArrow(lambda table: compare(table, basis, threshold), FOUND_SCHEMA), "found")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("others"))
    root = roots(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "uid")
    named = stored(
        classes.select("uid", "members", "least").join(counts, "uid", "left").join(root, "uid", "left")
        .select("uid", (F.coalesce("others", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("root", "uid").alias("root"), "least"), "named")
    heads = stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "heads")
    labelled = stored(named.join(heads, "root").select("uid", "n_links", "component_id"), "labelled")
    linked = (
        taking.join(classes.select("label_key", "vec", "uid"), ["label_key", "vec"]).select("uid", "vec_id").join(labelled, "uid")
        .select("vec_id", "n_links", "component_id")
    )
    alone = rows.filter(~F.col("fine")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
