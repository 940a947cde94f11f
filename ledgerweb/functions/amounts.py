"""Money arithmetic that does not depend on row order.

A double sum changes in its last digits with the order in which partial results arrive, so a
retried task or another partition count could move an account across a threshold. Amounts are
summed as decimals and handed on as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(24,8)"
MONEY_SUM = "decimal(34,8)"  # what Spark's sum makes of it


def money(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def money_sum(col: str | Column) -> Column:
    return F.sum(money(col)).cast("double")


def money_sum_if(condition: Column, col: str | Column) -> Column:
    return F.sum(F.when(condition, money(col)).otherwise(F.lit(0).cast(MONEY))).cast("double")


def rupees(col: str | Column, decimals: int = 2) -> Column:
    return F.concat(F.lit("₹"), F.format_number(col, decimals))


def percent(col: str | Column) -> Column:
    """A share in 0..1 as text with one decimal."""
    return F.format_string("%.1f%%", (F.col(col) if isinstance(col, str) else col) * 100)
