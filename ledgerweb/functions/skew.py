"""Joins with a per-key aggregate whose other side may have hot keys.

Adaptive execution splits a hot partition only where both sides of a join come straight from a shuffle. An
aggregate is already partitioned by its key, so Spark joins it as it is, and the hot key's rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reshuffled(key: str) -> Column:
    """A numeric key whose partitioning the planner doesn't know any more: the join shuffles the aggregate anew.

    The aggregate has one row for each key, so this is the smaller side.
    """
    return F.col(key).bitwiseOR(F.lit(0))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows in as many partitions as a shuffle has, by a hash of the keys.

    For few rows that each make many: adaptive execution goes by their bytes and would leave the work to one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
