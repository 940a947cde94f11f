"""A table as a stream of ordered slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerweb.functions.lineage import cut
from ledgerweb.functions.ordered import global_rank


def ranked_slices(df: DataFrame, order: list[Column], count: int) -> Iterator[DataFrame]:
    """The table in `count` slices of equal size, by place in `order`, whatever the values there are."""
    ranked = cut(global_rank(df, order, "_rank"))
    rows = ranked.agg(F.max("_rank")).scalar()
    return slices(ranked, F.floor((F.col("_rank") - 1) * count / rows).cast("int"), range(count), "_rank")


def slices(df: DataFrame, slice_of: Column, numbers: Iterator[int] | range, *drop: str) -> Iterator[DataFrame]:
    """The rows of slice 0, 1, ... of a table that is read once. A row that is in no slice is an error."""
    numbers = list(numbers)
    marked = cut(df.withColumn("_slice", slice_of).drop(*drop))
    if not marked.filter(~F.coalesce(F.col("_slice").isin(numbers), F.lit(False))).isEmpty():
        raise ValueError("a row lies in none of the slices")
    for number in numbers:
        yield marked.filter(marked["_slice"] == number).drop("_slice")


def open_stream(spark: SparkSession, landing: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landing)


def drive(parts: Iterator[DataFrame], landing: str, start: Callable[[], StreamingQuery]) -> None:
    """Let each slice arrive and run the query until it has taken it in.

    A slice is one micro-batch whatever its number of files: the query starts on its committed
    files only and resumes from its checkpoint, as it would after a lost driver.
    """
    for part in parts:
        part.write.mode("append").parquet(landing)
        query = start()
        query.awaitTermination()
