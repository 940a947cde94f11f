"""Writing results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, target: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace a table, schema included. A target with a slash is a path, else a catalog name.

    `fmt="delta"` works where the cluster has that package on its classpath. Rows of a partitioned
    table are first brought together by partition value; the hint lets Spark split a value that
    holds many rows over several files and put small ones together.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def export_csv(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """CSV with a header, as part files; `order` sorts over all parts."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).csv(path)
