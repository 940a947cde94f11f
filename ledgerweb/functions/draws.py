"""Reproducible draws: a uniform number in [0, 1) that depends only on its key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(salt: str, *key: str | Column) -> Column:
    """The same row gives the same number under any partitioning, retry or engine."""
    text = F.concat_ws(":", F.lit(salt), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(2.0 ** 32)


def uniform_between(low: float, high: float, salt: str, *key: str | Column) -> Column:
    return F.lit(float(low)) + uniform(salt, *key) * F.lit(float(high) - float(low))


def integer_between(low: int, high: int, salt: str, *key: str | Column) -> Column:
    """A whole number in [low, high]."""
    return (F.lit(low) + F.floor(uniform(salt, *key) * F.lit(high - low + 1))).cast("int")
