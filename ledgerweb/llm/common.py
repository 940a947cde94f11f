"""Helpers that the operators of this package share."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import scratch_path

ROW = ["row_file", "row_pos"]


# glibc keeps what large arrays have left in a worker's heap; mapped on their own, they go back at once. A worker that waits
# for its next task then holds little beside its libraries.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(8 << 20), "MALLOC_ARENA_MAX": "2",
                 "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, for runs without an installed one or `--py-files`, and
    give back memory. Settings of the session's own are kept.
    """
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: later steps survive lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns with a key for each row, `row_file, row_pos`.

    A stored table's rows are named by file and place in it, which no other split of the files changes.
    Other frames get running numbers; one that is keyed twice has to be stored before.
    """
    wanted = df.select(*[F.col(f"`{c}`") if isinstance(c, str) else c for c in columns], *_places(df))
    wanted.schema  # noqa: B018  resolves the names
    return wanted


def _places(df: DataFrame) -> list[Column]:
    if has_files(df):
        return [F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1])]
    return [F.lit(0).cast("bigint").alias(ROW[0]), F.monotonically_increasing_id().alias(ROW[1])]


def has_files(df: DataFrame) -> bool:
    """Whether the rows of `df` come straight from stored files."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index").schema  # noqa: B018  resolves the names
    except AnalysisException:
        return False
    return True


def remainder(column: str, by: int) -> Column:
    """crc32 of the value as text, modulo `by`; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % by


def dump(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed value."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        kind = a.dtype.str.encode()
        parts += [struct.pack("<BQ", len(kind), a.nbytes), kind, np.ascontiguousarray(a).tobytes()]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def load(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    (count,), at, arrays = struct.unpack_from("<I", raw), 4, []
    for _ in range(count):
        kind, size = struct.unpack_from("<BQ", raw, at)
        at += 9
        dtype = np.dtype(raw[at:at + kind].decode())
        at += kind
        arrays.append(np.frombuffer(raw, dtype, size // dtype.itemsize, at))
        at += size
    return arrays


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one after another."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(total)


def text_batches(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows, cut where a batch's `text` exceeds `most` bytes; a longer text stands alone."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column("text").to_pylist()]
