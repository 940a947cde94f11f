"""Exchange between blocks of documents and buckets of keys.

A corpus-wide question about words, n-grams or passages would shuffle one row per occurrence. Here
consecutive documents form a block of a few megabytes. A block sends each bucket one compressed list of its
distinct keys with their counts; the bucket merges the lists of all blocks and answers each in the order it was
asked. A key that a third of all documents contain is then one entry per block. Spark moves, spills and
retries the lists like any other rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import scratch_path
from ledgerweb.llm.common import text_batches

BLOCK_BYTES = 8 << 20
BUCKET_TEXT = 16 << 20
BLOCK_SCHEMA = "block long, n long, keys binary, body binary, parts array<struct<bucket int, data binary>>"
PART_SCHEMA = "block long, bucket int, data binary"


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the keys of all texts: as many as the session's shuffle partitions, more where one would get over `BUCKET_TEXT` bytes of texts.

    So the group that meets in one task doesn't grow with the corpus, whatever the session sets.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(_partitions(docs), -(-size // BUCKET_TEXT))


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def parts_of(parts: dict[int, bytes]) -> list[dict]:
    return [{"bucket": int(b), "data": d} for b, d in parts.items()]


def build(docs: DataFrame, make: Callable, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stored blocks of the rows of `docs`, which has a `text` column.

    `make(batch)` returns the block's body, its lists by bucket and a number that is kept as `n`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for held in gathered(text_batches(batches, block_bytes), block_bytes):
            body, parts, n = make(held)
            keys = ipc(held.drop_columns(["text"]))
            yield pa.RecordBatch.from_pylist(
                [{"block": number, "n": int(n), "keys": keys, "body": body, "parts": parts_of(parts)}], BLOCK_ARROW)
            number += 1

    return bucketed(docs.mapInArrow(run, BLOCK_SCHEMA), name)


def bucketed(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks stored by bucket of their number, so that joins on it don't shuffle their bodies.

    The catalog's entry is only needed to read the bucketing and goes at once; the files stay in the shared folder.
    """
    spark, table = blocks.sparkSession, f"blocks_{uuid.uuid4().hex}"
    (
        blocks.write.bucketBy(_partitions(blocks), "block").option("compression", "uncompressed")
        .option("path", scratch_path(spark, name)).saveAsTable(table)
    )
    held = spark.table(table)
    held.schema  # noqa: B018  resolves the table
    spark.sql(f"DROP TABLE {table}")
    return held


PART_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])
BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("body", pa.binary()),
    ("parts", pa.list_(pa.struct([("bucket", pa.int32()), ("data", pa.binary())]))),
])


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        more = pa.compute.sum(pa.compute.binary_length(batch.column("text"))).as_py() or 0
        if held and size + more > most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += more
    if held:
        yield pa.Table.from_batches(held)


def exchange(parts: DataFrame, merge: Callable) -> DataFrame:
    """`merge(list of data)` answers the lists that one bucket got, in their order; sorted by block."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        answers = merge(table.column("data").to_pylist(), table.column("block").to_pylist())
        return pa.Table.from_arrays(
            [table.column("block"), table.column("bucket"), pa.array(answers, pa.binary())], schema=PART_ARROW)

    return parts.groupBy("bucket").applyInArrow(run, PART_SCHEMA)


def sent(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.inline("parts"))


def ask(blocks: DataFrame, each: Callable) -> DataFrame:
    """The lists by bucket that `each(body, answers...)` makes of a block that is stored without them."""
    names = [c for c in blocks.columns if c.startswith("answers_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                got = [{x["bucket"]: x["data"] for x in batch.column(c)[i].as_py() or []} for c in names]
                parts = each(batch.column("body")[i].as_py(), *got)
                rows = [{"block": batch.column("block")[i].as_py(), **part} for part in parts_of(parts)]
                yield pa.RecordBatch.from_pylist(rows, PART_ARROW)

    return blocks.select("block", "body", *names).mapInArrow(run, PART_SCHEMA)


def answered(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Blocks with the answers they got, `answers_0` and so on: lists of (bucket, data) no longer than asked."""
    for i, replies in enumerate(answers):
        own = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias(f"answers_{i}"))
        blocks = blocks.join(own, "block", "left")
    return blocks


def replies(answers: DataFrame, name: str) -> DataFrame:
    """What each block was answered, as the list `name` of (bucket, data), stored by bucket of the block: later joins don't shuffle it."""
    return bucketed(answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias(name)), "replies")


def finish(blocks: DataFrame, each: Callable, schema: str) -> DataFrame:
    """`each(keys, body, answers...)` gives the rows of a block as Arrow columns; answers are dicts by bucket."""
    names = [c for c in blocks.columns if c.startswith("answers_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = pa.ipc.open_stream(batch.column("keys")[i].as_buffer()).read_all()
                got = [{x["bucket"]: x["data"] for x in batch.column(c)[i].as_py() or []} for c in names]
                yield from each(keys, batch.column("body")[i].as_py(), *got).to_batches()

    return blocks.mapInArrow(run, schema)


def by_bucket(buckets: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts entries by bucket, and each bucket's first place in it."""
    order = np.argsort(buckets, kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(count + 1))
