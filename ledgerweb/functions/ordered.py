"""Running totals over a sorted table without gathering a group in one task.

A window ordered over a whole table, or over one account that owns a third of it, sorts that
group in a single task. Here the table is range-partitioned on (by, order), which cuts a long
group into several partitions. Each partition computes its own running values; what a partition
needs from earlier ones is the total per (group, partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import cut

PART = "_part"


def running(
    df: DataFrame,
    by: list[str],
    order: list[Column],
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Add running sums and maxima over `order` within `by`.

    `order` has to be unique within a group. With `inclusive=False` a row sees only the rows
    before it; the first row of a group then gets sum 0 and maximum NULL.
    """
    sums, maxes = sums or {}, maxes or {}
    parts = cut(
        df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn(PART, F.spark_partition_id())
    )
    measures = [(name, F.sum, expr) for name, expr in sums.items()]
    measures += [(name, F.max, expr) for name, expr in maxes.items()]

    totals = parts.groupBy(*by, PART).agg(*[fn(expr).alias(name) for name, fn, expr in measures])
    earlier = W.partitionBy(*by).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    # A group starts in an earlier partition only where a partition border cuts it, so at most
    # one row per border is left: fewer rows than partitions, whatever the data.
    carried = (
        totals.select(*by, PART,
                      *[fn(name).over(earlier).alias(f"_carry_{name}") for name, fn, _ in measures],
                      F.row_number().over(W.partitionBy(*by).orderBy(PART)).alias("_nth"))
        .filter("_nth > 1").drop("_nth")
    )
    inside = (
        W.partitionBy(*by, PART).orderBy(*order)
        .rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    )
    result = parts.select("*", *[fn(expr).over(inside).alias(f"_in_{name}") for name, fn, expr in measures])
    result = result.join(F.broadcast(carried), [*by, PART], "left")
    columns = [F.col(c) for c in df.columns]
    columns += [(F.coalesce(F.col(f"_carry_{name}"), F.lit(0)) + F.coalesce(F.col(f"_in_{name}"), F.lit(0)))
                .alias(name) for name in sums]
    columns += [F.greatest(f"_carry_{name}", f"_in_{name}").alias(name) for name in maxes]
    return result.select(*columns)


def prior_moments(df: DataFrame, by: list[str], order: list[Column], value: str) -> DataFrame:
    """Add `n, mean, m2, low, high` of `value` over the rows before each row: m2 sums the squared distances from the mean.

    Partitions' moments are merged two by two (Chan, Golub and LeVeque, 1983), not taken from sums of squares: large
    amounts that lie close together keep their digits.
    """
    x = F.col(value).cast("double")
    moments = [F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
               F.min(x).alias("low"), F.max(x).alias("high")]
    parts = cut(
        df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn(PART, F.spark_partition_id())
    )
    earlier = W.partitionBy(*by).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    one = F.struct("n", "mean", "m2", "low", "high")
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"),
                       F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    # One row for each partition that a group reaches into; kept, as above, for all but its first.
    carried = (
        parts.groupBy(*by, PART).agg(*moments)
        .select(*by, PART, F.collect_list(one).over(earlier).alias("parts"),
                F.row_number().over(W.partitionBy(*by).orderBy(PART)).alias("_nth"))
        .filter("_nth > 1").select(*by, PART, F.aggregate("parts", nothing, _merged).alias("_carry"))
    )
    inside = W.partitionBy(*by, PART).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    own = parts.select("*", F.struct(
        F.count(x).over(inside).alias("n"), F.avg(x).over(inside).alias("mean"),
        (F.var_pop(x).over(inside) * F.count(x).over(inside)).alias("m2"),
        F.min(x).over(inside).alias("low"), F.max(x).over(inside).alias("high")).alias("_own"))
    own = own.join(F.broadcast(carried), [*by, PART], "left")
    filled = [F.struct(*[F.coalesce(F.col(f"{c}.{n}"), F.lit(0.0) if n in ("mean", "m2") else F.lit(0).cast("bigint")).alias(n)
                         for n in ("n", "mean", "m2")], F.col(f"{c}.low").alias("low"), F.col(f"{c}.high").alias("high"))
              for c in ("_carry", "_own")]
    return own.select(*df.columns, _merged(*filled).alias("_all")).select(*df.columns, "_all.*")


def _merged(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    share = F.coalesce(F.try_divide(b["n"], n), F.lit(0.0))
    return F.struct(
        n.alias("n"), (a["mean"] + apart * share).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * share * a["n"]).alias("m2"),
        F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"))


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """1-based position in the total order; `order` has to be unique."""
    return running(df, [], order, sums={name: F.lit(1).cast("bigint")}, inclusive=True)
