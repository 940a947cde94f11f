"""Near duplicates by SimHash fingerprints, searched in BK-trees.

Two fingerprints that differ in at most r of 64 bits agree in `agree` whole bands of r + agree. Every choice of that many bands
makes a set of shards, the fingerprints alike in those bands. A shard's tree holds its distinct fingerprints, children
keyed by their Hamming distance to the parent, and lives in the task that searches it; a search follows only the edges
within the radius of the distance at hand. Searching goes outwards from a fingerprint over the ones found, which leave
the tree, so a dense cluster is walked once and gives one link for each member, not all pairs. The trees of all shards
together grow with the corpus and are therefore not broadcast as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm.backoff_lm import words_of
from ledgerweb.llm.common import ROW, keyed, stored, text_batches, texts_of
from ledgerweb.llm.connected import roots

SHINGLE = 4
RADIUS = 4
AGREE = 2
SEED = 42
SHARD_LIMIT = 20_000  # fingerprints of one tree; a larger shard is cut and its parts are searched two by two
BATCH_BYTES = 4 << 20
BITS_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits that more than half of the shingles' XXH64 have set; 0 without words."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - span + 1].tolist(), ends[span - 1:].tolist())],
                      dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        octets = hashes[at:at + BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id`, the row's key and `fp`, the fingerprint's 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, BATCH_BYTES):
            found = np.array([fingerprint(t, shingle) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", *ROW)), pa.array(found)], names=["doc_id", *ROW, "fp"])

    wanted = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return wanted.mapInArrow(run, f"doc_id long, {ROW[0]} long, {ROW[1]} long, fp long")


class BKTree:
    """Distinct fingerprints; what a search finds leaves the tree, and branches without any left are passed by."""

    def __init__(self, values: list[int]):
        self.root: list | None = None
        for value in values:
            self._add(value)

    def _add(self, value: int) -> None:
        # A node: value, children by distance, fingerprints left in it and below, itself still there.
        node, fresh = self.root, [value, {}, 1, True]
        if node is None:
            self.root = fresh
            return
        while True:
            node[2] += 1
            distance = (node[0] ^ value).bit_count()
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = fresh
                return
            node = child

    def take(self, value: int, radius: int) -> list[int]:
        """The fingerprints within `radius` bits that are left, taken out."""
        found: list[int] = []
        if self.root is not None and self.root[2]:
            self._take(self.root, value, radius, found)
        return found

    def _take(self, root: list, value: int, radius: int, found: list[int]) -> None:
        path, order = [root], []
        while path:
            node = path.pop()
            order.append(node)
            distance = (node[0] ^ value).bit_count()
            if distance <= radius and node[3]:
                node[3] = False
                found.append(node[0])
            for edge, child in node[1].items():
                if child[2] and distance - radius <= edge <= distance + radius:
                    path.append(child)
        for node in reversed(order):  # children before their parents
            node[2] = node[3] + sum(child[2] for child in node[1].values())


def clusters(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """(member, first member) for the members of clusters linked within `radius`, but the first."""
    tree = BKTree(values)
    for first in values:
        queue = [v for v in tree.take(first, 0)]
        while queue:
            for member in tree.take(queue.pop(), radius):
                queue.append(member)
                yield member, first


def masks(radius: int, agree: int) -> list[int]:
    """Bit masks of all choices of `agree` bands out of radius + agree."""
    count = radius + agree
    edges = [64 * i // count for i in range(count + 1)]
    bands = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(chosen) for chosen in combinations(bands, agree)]


def links(distinct: DataFrame, radius: int = RADIUS, agree: int = AGREE, limit: int = SHARD_LIMIT) -> DataFrame:
    """`a, b`: links between distinct fingerprints `fp` that connect all that differ in at most `radius` bits."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(radius, agree)]
    shard = F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(signed)
    ])).alias("shard")
    members = distinct.select("fp", shard).select("fp", "shard.*")
    shards = stored(members.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shards")
    cuts = F.ceil(F.col("n") / F.lit(limit))
    own = F.pmod(F.xxhash64("fp"), cuts)
    # A shard in k cuts is searched in cells of two cuts each, so that every two fingerprints meet in one of them.
    cell = F.explode(F.when(F.col("n") <= limit, F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))))
                     .otherwise(F.transform(F.sequence(F.lit(0).cast("long"), cuts - 1),
                                            lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j"))))).alias("cell")
    cells = members.join(shards, ["mask", "bits"]).select("mask", "bits", cell, "fp").select("mask", "bits", "cell.*", "fp")
    key = ["mask", "bits", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell_values in _groups(batches, key):
            found = list(clusters(cell_values.view(np.uint64).tolist(), radius))
            if found:
                pairs = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    dealt = cells.repartition(*key).sortWithinPartitions(*key, "fp")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[np.ndarray]:
    """The `fp` values of each run of equal keys."""
    held_key, held = None, []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(c).to_numpy() for c in key]
        values = batch.column("fp").to_numpy()
        breaks = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *breaks], [*breaks, len(values)], strict=True):
            name = tuple(c[a] for c in columns)
            if name != held_key and held:
                yield np.concatenate(held)
                held = []
            held_key = name
            held.append(values[a:b])
    if held:
        yield np.concatenate(held)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, agree: int = AGREE,
                    limit: int = SHARD_LIMIT) -> DataFrame:
    """`doc_id`, the row's key, `fp, component_id, keep` for every row of `docs(doc_id, text)`.

    Documents link where their fingerprints differ in at most `radius` bits. `component_id` is the smallest doc_id
    reachable (null where all are null); `keep` marks one row of each component, that with the smallest doc_id, then the first one stored.
    Null texts count as empty; texts without words have fingerprint 0 and link like any other. Repeated rows are members
    each. Other columns are ignored; no documents give no rows.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW)).alias("first")
    classes = stored(prints.groupBy("fp").agg(first), "classes")
    root = roots(links(classes.select("fp"), radius, agree, limit))
    named = stored(
        classes.join(root.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"),
        "named")
    heads = stored(named.groupBy("root").agg(F.min("first").alias("head")), "heads")
    labelled = stored(named.join(heads, "root").select("fp", "head"), "labelled")
    same = [F.col(f"head.{c}").eqNullSafe(F.col(c)) for c in ROW]
    return prints.join(labelled, "fp").select(
        "doc_id", *ROW, "fp", F.col("head.doc_id").alias("component_id"), (same[0] & same[1]).alias("keep"))


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
