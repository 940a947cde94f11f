"""The k nearest rows of every row, exactly, and synthetic rows between neighbours.

Columns are scaled to 0..1. Each row first gets a bound: rows are sorted along a Z-order curve, and the k-th distance among the k before
and the k after it can only be too far. Then it asks all cells of a grid that a ball of that radius touches; the grid's width follows the radius, so
that these are two cells each way at most. Nobody nearer can lie anywhere else. Equal rows are one point, with the ids that can be
among anyone's nearest, so a group of copies costs a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.functions.draws import uniform
from ledgerweb.functions.lineage import stored

LEVELS = 30       # cells of 2**-30 are the smallest
CURVE_BITS = 10   # of each column on the curve
CURVE_COLUMNS = 6
GRID_COLUMNS = 3  # the most spread ones; more would only make more cells
SLACK = 1 + 1e-9  # far above the rounding of a distance


def scaled(df: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """`key, x` with the columns scaled to 0..1 by their smallest and largest values; nulls count as 0, a column of one value is 0 throughout."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    extent = df.agg(*[F.min(v).alias(f"low{i}") for i, v in enumerate(values)], *[F.max(v).alias(f"high{i}") for i, v in enumerate(values)]).first()
    parts = []
    for i, v in enumerate(values):
        low, high = extent[f"low{i}"], extent[f"high{i}"]
        parts.append((v - F.lit(low)) / F.lit(high - low) if low is not None and high > low else F.lit(0.0))
    return df.select(F.col(key), F.array(*parts).alias("x"))


def _apart(a: Column, b: Column, count: int) -> Column:
    """The squared distance."""
    return reduce(lambda s, i: s + (a[i] - b[i]) * (a[i] - b[i]), range(count), F.lit(0.0))


def _curve(count: int) -> Column:
    """The place on a Z-order curve through logarithms of the columns, as amounts crowd near 0."""
    used = min(count, CURVE_COLUMNS)
    most = (1 << CURVE_BITS) - 1
    steps = [F.floor(F.log1p(F.col("x")[i] * 1e6) / F.lit(13.815511557963774) * most).cast("bigint") for i in range(used)]
    place = F.lit(0).cast("bigint")
    for bit in range(CURVE_BITS):
        for i, s in enumerate(steps):
            place = place + F.shiftleft(F.shiftright(s, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * used + i)
    return place


def nearest(df: DataFrame, columns: list[str], k: int = 5, key: str = "id") -> DataFrame:
    """`key, rank, neighbor, distance`: the k nearest other rows of each row, equally near ones by their key.

    Distances are Euclidean over the scaled columns. With fewer than k other rows all are returned. Keys have to be different.
    """
    # Read twice: for the extent and to scale.
    return _nearest(stored(df.select(key, *dict.fromkeys(c for c in columns if c != key)), "rows"), columns, k, key)


def _nearest(rows: DataFrame, columns: list[str], k: int, key: str = "id") -> DataFrame:
    """`nearest` of stored rows."""
    count = len(columns)
    points = stored(scaled(rows, columns, key).withColumnRenamed(key, "row"), "points")
    first = F.row_number().over(W.partitionBy("x").orderBy("row"))
    members = points.select("x", "row", first.alias("place")).filter(F.col("place") <= k + 1)
    distinct = stored(
        members.groupBy("x").agg(F.sort_array(F.collect_list("row")).alias("rows")).select("x", "rows", F.monotonically_increasing_id().alias("point")), "distinct")
    spread = distinct.agg(*[F.stddev_pop(F.col("x")[i]).alias(str(i)) for i in range(count)]).first()
    grid = sorted(range(count), key=lambda i: -(spread[str(i)] or 0.0))[:GRID_COLUMNS]

    along = stored(
        distinct.withColumn("curve", _curve(count)).repartitionByRange("curve", "point").withColumn("part", F.spark_partition_id()), "along")
    beside = W.partitionBy("part").orderBy("curve", "point").rowsBetween(-k, k)
    distances = F.sort_array(F.transform("beside", lambda y: _apart(F.col("x"), y, count)))
    copies = F.size("rows") > k  # the nearest ones are equal
    bound = F.when(copies, F.lit(0.0)).otherwise(F.coalesce(F.get(distances, F.lit(k)), F.lit(float(count)))) * SLACK
    asking = along.select("point", "x", "rows", F.collect_list("x").over(beside).alias("beside")).select("point", "x", bound.alias("bound"))
    radius = F.sqrt("bound")
    level = F.when(F.col("bound") == 0, F.lit(LEVELS)).otherwise(F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.floor(-F.log2(2 * radius)).cast("int"))))
    asking = stored(asking.withColumn("level", level), "asking")

    cells = F.pow(F.lit(2.0), F.col("level"))

    def touched(i: int) -> Column:
        def cell(v: Column) -> Column:
            return F.greatest(F.lit(0), F.least(F.floor(v * cells).cast("bigint"), cells.cast("bigint")))

        return F.sequence(cell(F.col("x")[i] - radius * SLACK), cell(F.col("x")[i] + radius * SLACK))

    asked = asking
    for n, i in enumerate(grid):
        asked = asked.withColumn(f"c{n}", F.explode(touched(i)))
    on = ["level", *[f"c{n}" for n in range(len(grid))]]
    levels = [r["level"] for r in asking.select("level").distinct().collect()]  # 31 at most
    held = distinct.select("point", "x", "rows", F.explode(F.array(*[F.lit(n).cast("int") for n in levels]) if levels else F.array().cast("array<int>")).alias("level"))
    held = held.select("*", *[F.floor(F.col("x")[i] * cells).cast("bigint").alias(f"c{n}") for n, i in enumerate(grid)])
    apart = _apart(F.col("x"), F.col("y"), count)
    met = (
        asked.join(held.select(F.col("x").alias("y"), "rows", *on), on).withColumn("apart", apart).filter(F.col("apart") <= F.col("bound"))
        .select("point", "apart", F.explode("rows").alias("neighbor"))
    )
    place = F.row_number().over(W.partitionBy("point").orderBy("apart", "neighbor"))
    # One more than k, as each row then leaves out itself.
    found = stored(
        met.withColumn("place", place).filter(F.col("place") <= k + 1)
        .groupBy("point").agg(F.sort_array(F.collect_list(F.struct("place", "neighbor", "apart"))).alias("found")), "nearest")
    own = F.slice(F.filter("found", lambda f: f["neighbor"] != F.col("row")), 1, k)
    return (
        points.join(distinct.select("x", "point"), "x").join(found, "point").select("row", F.posexplode(own).alias("at", "one"))
        .select(F.col("row").alias(key), (F.col("at") + 1).alias("rank"), F.col("one.neighbor").alias("neighbor"), F.sqrt("one.apart").alias("distance"))
    )


def smote(df: DataFrame, columns: list[str], label: str = "label", k: int = 5, per_row: int = 1, salt: str = "smote") -> DataFrame:
    """Synthetic positives `id, <columns>, label`, each between a positive row and one of its `k` nearest positive ones.

    Draw j of a row takes a neighbour, and a place on the way to it, by a hash of its id and j. A positive alone gives no rows; null values count as 0.
    """
    positives = stored(df.filter(F.col(label) == 1).select("id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]), "positives")
    near = _nearest(positives, columns, k)
    known = stored(near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "neighbor"))).alias("near")), "near")
    draws = known.select("id", "near", F.explode(F.sequence(F.lit(0), F.lit(per_row - 1))).alias("draw"))
    chosen = draws.withColumn("other", F.col("near")[F.floor(uniform(salt, F.lit("neighbor"), "id", "draw") * F.size("near")).cast("int")]["neighbor"])
    partners = positives.select(F.col("id").alias("other"), F.struct(*columns).alias("partner"))
    u = uniform(salt, F.lit("step"), "id", "draw")
    return chosen.join(positives, "id").join(partners, "other").select(
        F.concat_ws("#", "id", F.col("draw").cast("string")).alias("id"),
        *[(F.col(c) + u * (F.col("partner")[c] - F.col(c))).alias(c) for c in columns], F.lit(1).alias(label))
