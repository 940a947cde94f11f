"""Exact top-k by inner product with a three-phase uniform threshold (Cao and Wang, PODC 2004).

The components of all vectors are dealt to a few nodes; a candidate's score is the sum of its local scores there.
Phase 1 gathers each node's k best local scores of a query and takes the k-th best total among the candidates seen as a
safe bound; these few totals, k candidates a node at most, are taken from the vectors of each pair. Phase 2 hands each query's cutoff, the bound divided by the number of nodes, to all nodes, which
send every entry that reaches it: whoever is below it everywhere can't reach the bound. Phase 3 tells each node
what the others sent; it adds its own local score and keeps the pairs that can still reach the bound, a node that sent nothing
being below the cutoff. On two nodes those are the pairs that do reach it. Their totals are taken from both vectors and ranked.

A node's work is cut into cells of some queries and some candidates, dealt by Spark, and done as a block of a matrix
product; queries, candidates and cutoffs are shuffled to the cells, since all of them grow with the data.

All of this is done once for equal vectors, with the k + 1 rows of each that rank first: no query needs more of them, its own
row being one that it may have to leave out. Rows come back when the best of a vector are known, so that copies cost a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.llm.common import stored

NODES = 2
CELL_QUERIES = 512
CELL_CANDIDATES = 4096
CELL = ["node", "q_block", "c_block"]
ENTRY = "q long, c long, node int, q_block int, c_block int, local long"
ENTRY_ARROW = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("node", pa.int32()), ("q_block", pa.int32()),
                         ("c_block", pa.int32()), ("local", pa.int64())])

PAIR = "q long, c long"
PAIR_ARROW = pa.schema([("q", pa.int64()), ("c", pa.int64())])


def scaled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """`uid, vec_id, vec`: whole numbers floor(scale * x) of the vectors that take part, each row with a number of its own.

    A vector that is null or holds a null or non-finite component takes no part.
    """
    x = F.col("embedding").cast("array<double>")
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return stored(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.coalesce(fine, F.lit(False)))
        .select(F.monotonically_increasing_id().alias("uid"), "vec_id", whole.alias("vec")), "vectors")


def _matrix(rows: pa.Table) -> np.ndarray:
    column = rows.column("part").combine_chunks()
    width = len(column.values) // len(column) if len(column) else 0
    return column.values.to_numpy().astype(np.int64).reshape(len(column), width)


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers, always exact."""
    if not queries.size or not candidates.size:
        return np.zeros((len(queries), len(candidates)), dtype=np.int64)
    if _bound(queries, candidates) < 2 ** 53:
        return (queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    return queries @ candidates.T


def _bound(queries: np.ndarray, candidates: np.ndarray) -> int:
    """No inner product is larger; beyond 64 bits there is no score, and an error is raised."""
    if not queries.size or not candidates.size:
        return 0
    bound = int(np.abs(queries).max()) * int(np.abs(candidates).max()) * queries.shape[1]
    if bound >= 2 ** 62:
        raise OverflowError("a score could exceed 64 bits")
    return bound


def _entries(cell: pa.Table, q: np.ndarray, c: np.ndarray, local: np.ndarray) -> pa.Table:
    fixed = [pa.array(np.full(len(q), cell.column(name)[0].as_py()), pa.int32()) for name in CELL]
    return pa.Table.from_arrays([pa.array(q, pa.int64()), pa.array(c, pa.int64()), *fixed, pa.array(local, pa.int64())], schema=ENTRY_ARROW)


def _narrowest(least: int, most: int) -> str:
    """The smallest SQL type for whole numbers from `least` to `most`: replicated vectors take as little room as they can."""
    for bits, name in ((16, "smallint"), (32, "int")):
        if -(1 << bits - 1) <= least and most < 1 << bits - 1:
            return name
    return "bigint"


def _split(cell: pa.Table) -> tuple[pa.Table, pa.Table]:
    asks = cell.column("asks")
    return cell.filter(asks), cell.filter(pa.compute.invert(asks))


def _others(asking: np.ndarray, candidates: pa.Table) -> np.ndarray:
    """Where a candidate has a row that is not the query itself."""
    alone = candidates.column("members").to_numpy() == 1
    return (asking[:, None] != candidates.column("uid").to_numpy()[None, :]) | ~alone[None, :]


def best_local(cell: pa.Table, k: int) -> pa.Table:
    """Phase 1: the k best local scores of each query."""
    queries, candidates = _split(cell)
    asking, ids = queries.column("uid").to_numpy(), candidates.column("uid").to_numpy()
    scores = _products(_matrix(queries), _matrix(candidates))
    others = _others(asking, candidates)
    scores = np.where(others, scores, np.iinfo(np.int64).min)
    most = min(k, len(ids))
    at = np.argpartition(-scores.astype(np.float64), most - 1, axis=1)[:, :most] if most else np.zeros((len(asking), 0), np.int64)
    q = np.repeat(np.arange(len(asking)), at.shape[1])
    c = at.reshape(-1)
    kept = others[q, c]
    q, c = q[kept], c[kept]
    return _entries(cell, asking[q], ids[c], scores[q, c])


def reaching(cell: pa.Table, nodes: int) -> pa.Table:
    """Phase 2: every entry of a local score at or above the query's cutoff; all entries where there is no bound."""
    queries, candidates = _split(cell)
    asking, ids = queries.column("uid").to_numpy(), candidates.column("uid").to_numpy()
    scores = _products(_matrix(queries), _matrix(candidates))
    bound = queries.column("bound")
    none = bound.is_null().to_numpy()
    # local * nodes >= bound, rounded up without leaving the integers
    least = -(-bound.fill_null(0).to_numpy() // nodes)
    q, c = np.nonzero(((scores >= least[:, None]) | none[:, None]) & _others(asking, candidates))
    return _entries(cell, asking[q], ids[c], scores[q, c])


def possible(cell: pa.Table, told: pa.Table, nodes: int) -> pa.Table:
    """Phase 3: of the pairs that other nodes sent, those that can reach the query's bound with the local score here."""
    if not len(told) or not len(cell):
        return PAIR_ARROW.empty_table()
    queries, candidates = _split(cell)
    asking, ids = queries.column("uid").to_numpy(), candidates.column("uid").to_numpy()
    by_q, by_c = np.argsort(asking), np.argsort(ids)
    q = by_q[np.searchsorted(asking[by_q], told.column("q").to_numpy())]
    c = by_c[np.searchsorted(ids[by_c], told.column("c").to_numpy())]
    pair, which, senders = np.unique(q * len(ids) + c, return_inverse=True, return_counts=True)
    q, c = pair // len(ids), pair % len(ids)
    most = _products(_matrix(queries), _matrix(candidates))[q, c]
    np.add.at(most, which, told.column("local").to_numpy())
    bound = queries.column("bound")
    none, bound = bound.is_null().to_numpy()[q], bound.fill_null(0).to_numpy()[q]
    # Nodes that sent nothing are at least one below the cutoff.
    most += (nodes - 1 - senders) * (-(-bound // nodes) - 1)
    kept = none | (most >= bound)
    return pa.table([pa.array(asking[q[kept]]), pa.array(ids[c[kept]])], schema=PAIR_ARROW)


def top_k(vectors: DataFrame, is_query, k: int = 5, nodes: int = NODES, scale: int = 256,
          cell_queries: int = CELL_QUERIES, cell_candidates: int = CELL_CANDIDATES) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k best of `vectors(vec_id, embedding)` for each row where `is_query` holds.

    Candidates are all rows but the query's own. Equal scores rank by vec_id (null last), then in a fixed order of the
    rows; fewer than k candidates are all returned. Repeated ids and rows are rows of their own, as query and as
    candidate. Vectors of different lengths count as filled up with zeros. Other columns are ignored; no
    vectors or no queries give no rows. `is_query` is a condition on vec_id; null means no. Where a score could
    exceed 62 bits, the job stops with an error.
    """
    held = scaled(vectors, scale)
    width, least, most = held.agg(F.max(F.size("vec")), F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
    width = width or 0
    filled = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec"))).cast(f"array<{_narrowest(least or 0, most or 0)}>")
    rows = held.select(filled.alias("vec"), "uid", "vec_id", F.coalesce(is_query, F.lit(False)).alias("asks"))
    # `uid` of a distinct vector is that of its first row, `ranked` its k + 1 first rows.
    first = F.row_number().over(W.partitionBy("vec").orderBy(F.asc_nulls_last("vec_id"), "uid"))
    distinct = stored(
        rows.select("vec", "uid", "vec_id", first.alias("place")).filter(F.col("place") <= k + 1)
        .groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "uid"))).alias("ranked"))
        .select("vec", F.col("ranked")[0]["uid"].alias("uid"), F.size("ranked").alias("members"), "ranked"), "distinct")
    asked = stored(
        rows.filter("asks").select("vec", F.col("uid").alias("row"), F.col("vec_id").alias("query_id"))
        .join(distinct.select("vec", F.col("uid").alias("q")), "vec").select("q", "row", "query_id"), "asked")
    asking = stored(distinct.join(asked.select(F.col("q").alias("uid")).distinct(), "uid").select("uid", "vec", "members"), "queries")
    q_blocks = max(1, -(-asking.count() // cell_queries))
    c_blocks = max(1, -(-distinct.count() // cell_candidates))
    edges = [width * i // nodes for i in range(nodes + 1)]
    parts = F.explode(F.array(*[
        F.struct(F.lit(n).cast("int").alias("node"), F.slice("vec", edges[n] + 1, edges[n + 1] - edges[n]).alias("part"))
        for n in range(nodes)
    ])).alias("on")
    q_block = F.pmod(F.xxhash64("uid"), F.lit(q_blocks)).cast("int")
    c_block = F.pmod(F.xxhash64(F.lit(1), "uid"), F.lit(c_blocks)).cast("int")

    def cells(bounds: DataFrame | None = None) -> DataFrame:
        queries = asking.withColumn("bound", F.lit(None).cast("long"))
        if bounds is not None:
            queries = asking.join(bounds, "uid", "left")
        queries = queries.select("uid", "members", "bound", F.lit(True).alias("asks"), q_block.alias("q_block"),
                                 F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("c_block"), "vec")
        candidates = distinct.select("uid", "members", F.lit(None).cast("long").alias("bound"), F.lit(False).alias("asks"),
                                     F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"), c_block.alias("c_block"), "vec")
        both = queries.unionByName(candidates)
        fixed = ["uid", "members", "bound", "asks", "q_block", "c_block"]
        return both.select(*fixed, parts).select(*fixed, "on.*")

    # Phase 1. Totals of the candidates seen, then the k-th best of their rows for each query that has k.
    best = cells().groupBy(*CELL).applyInArrow(lambda cell: best_local(cell, k), ENTRY)
    in_node = F.row_number().over(W.partitionBy("q", "node").orderBy(F.desc("local"), "c"))
    seen = stored(best.withColumn("place", in_node).filter(F.col("place") <= k).drop("place"), "seen")
    total = _pair_totals(seen.select("q", "c").distinct(), asking, distinct)
    others = F.col("members") - (F.col("q") == F.col("c")).cast("int")
    so_far = F.sum(others).over(W.partitionBy("q").orderBy(F.desc("total"), "c").rowsBetween(W.unboundedPreceding, W.currentRow))
    bounds = stored(
        total.withColumn("so_far", so_far).filter(F.col("so_far") >= k).groupBy(F.col("q").alias("uid")).agg(F.max("total").alias("bound")),
        "bounds")
    # Phases 2 and 3.
    sent = stored(cells(bounds).groupBy(*CELL).applyInArrow(lambda cell: reaching(cell, nodes), ENTRY), "reaching")
    pairs = sent.select("q", "c")
    if nodes > 1:
        others = F.array_except(F.array(*[F.lit(n).cast("int") for n in range(nodes)]), F.array("node"))
        told = sent.select("q", "c", "local", "q_block", "c_block", F.explode(others).alias("node"))
        pairs = (
            cells(bounds).groupBy(*CELL).cogroup(told.groupBy(*CELL))
            .applyInArrow(lambda cell, told: possible(cell, told, nodes), PAIR).distinct()
        )
    reached = (
        _pair_totals(pairs, asking, distinct).join(bounds.withColumnRenamed("uid", "q"), "q", "left")
        .filter(F.col("bound").isNull() | (F.col("total") >= F.col("bound")))
        .select("q", "total", F.inline(F.arrays_zip(F.col("ranked.vec_id").alias("ids"), F.col("ranked.uid").alias("rows"))))
    )
    place = F.row_number().over(W.partitionBy("q").orderBy(F.desc("total"), F.asc_nulls_last("ids"), "rows"))
    # One more than k, as each query then leaves out its own row.
    found = stored(
        reached.withColumn("place", place).filter(F.col("place") <= k + 1)
        .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "rows", "ids", "total"))).alias("found")), "found")
    own = F.slice(F.filter("found", lambda f: f["rows"] != F.col("row")), 1, k)
    return (
        asked.join(found, "q").select("query_id", F.posexplode(own).alias("at", "one"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.ids").alias("vec_id"), F.col("one.total").alias("score"))
    )


def _pair_totals(pairs: DataFrame, asking: DataFrame, distinct: DataFrame) -> DataFrame:
    """`q, c, members, ranked, total` of few pairs, from both vectors of each; sent to cells, all vectors would travel for them."""
    products = F.zip_with("asked", "vec", lambda a, b: a.cast("long") * b.cast("long"))
    return (
        pairs.join(asking.select(F.col("uid").alias("q"), F.col("vec").alias("asked")), "q")
        .join(distinct.select(F.col("uid").alias("c"), "members", "ranked", "vec"), "c")
        .select("q", "c", "members", "ranked", F.aggregate(products, F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))
    )
