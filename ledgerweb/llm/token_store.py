"""Token ids in bit-plane shuffled, compressed chunks.

Documents are sorted by id into shards. A shard's ids form one stream, cut into chunks of a fixed number of ids.
A chunk is transposed into byte planes (all lowest bytes, then all second bytes, ...) or bit planes, and every
plane is compressed by itself with zstandard: the high planes of small ids nearly vanish. A chunk row also
holds its entry of the chunk index: its place in the shard and the documents of which it holds pieces, so a
chunk can be read alone. The tables are Parquet, written and committed by Spark:

`chunks`: shard, chunk, first, n_ids, kind ("byte" or "bit"), planes (list of zstandard frames), plane_bytes, and for
each piece doc_id, doc_start (in the shard), doc_tokens, piece_at (in the document), piece_len.
`shards`: shard, start (ids of all shards before it), n_ids.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.llm.common import stored, text_batches, texts_of
from ledgerweb.llm.token_ids import encoder

CHUNK_IDS = 1 << 16
BATCH_BYTES = 4 << 20
CHUNKS = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("kind", pa.string()),
    ("planes", pa.list_(pa.binary())), ("plane_bytes", pa.list_(pa.int32())),
    ("pieces", pa.list_(pa.struct([("doc_id", pa.int64()), ("doc_start", pa.int64()), ("doc_tokens", pa.int64()),
                                   ("piece_at", pa.int64()), ("piece_len", pa.int32())]))),
])
CHUNKS_SQL = ("shard int, chunk int, first long, n_ids int, kind string, planes array<binary>, plane_bytes array<int>, "
              "pieces array<struct<doc_id: long, doc_start: long, doc_tokens: long, piece_at: long, piece_len: int>>")


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = 3) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids, the lowest first."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    if kind == "bit":
        bits = np.unpackbits(octets, axis=1, bitorder="little").reshape(4, len(ids), 8)
        rows = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    else:
        rows = octets
    pack = zstandard.ZstdCompressor(level=level).compress
    return [pack(np.ascontiguousarray(row).tobytes()) for row in rows]


def from_planes(planes: list[bytes], n_ids: int, kind: str) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    rows = [np.frombuffer(unpack(p), np.uint8) for p in planes]
    if kind == "bit":
        bits = np.stack([np.unpackbits(row, count=n_ids, bitorder="little") for row in rows])
        octets = np.packbits(bits.reshape(4, 8, n_ids).transpose(0, 2, 1), axis=2, bitorder="little")[:, :, 0]
    else:
        octets = np.stack(rows)
    return np.ascontiguousarray(octets.T).view("<u4").reshape(-1)


class ChunkWriter:
    """Cuts one shard's stream of documents into chunk rows."""

    def __init__(self, shard: int, chunk_ids: int, kind: str):
        self.shard, self.size, self.kind = shard, chunk_ids, kind
        self.chunk, self.first, self.at = 0, 0, 0
        self.held: list[np.ndarray] = []
        self.pieces: list[dict] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        start, done = self.at, 0
        while done < len(ids):
            take = min(len(ids) - done, self.first + self.size - self.at)
            self.held.append(ids[done:done + take])
            self.pieces.append({"doc_id": doc_id, "doc_start": start, "doc_tokens": len(ids), "piece_at": done,
                                "piece_len": take})
            done, self.at = done + take, self.at + take
            if self.at == self.first + self.size:
                yield self.flush()

    def flush(self) -> dict:
        planes = to_planes(np.concatenate(self.held), self.kind)
        row = {"shard": self.shard, "chunk": self.chunk, "first": self.first, "n_ids": self.at - self.first,
               "kind": self.kind, "planes": planes, "plane_bytes": [len(p) for p in planes], "pieces": self.pieces}
        self.chunk, self.first, self.held, self.pieces = self.chunk + 1, self.at, [], []
        return row


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, chunk_ids: int = CHUNK_IDS,
              kind: str = "byte") -> None:
    """Encode `docs(doc_id, text)` and write both tables below `path`.

    Null texts count as empty and give the end id alone; documents without id come first; repeated ids and
    rows are kept, in the order of their texts. A text of any length is cut over as many chunks as it needs.
    Other columns are ignored. No documents give two empty tables.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = encoder(tokenizer).encode, ChunkWriter(TaskContext.get().partitionId(), chunk_ids, kind)
        end = np.array([end_id], dtype="<u4")
        for batch in text_batches(batches, BATCH_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch)), strict=True):
                for row in out.add(doc_id, np.concatenate([ids, end])):
                    yield pa.RecordBatch.from_pylist([row], CHUNKS)
        if out.held:
            yield pa.RecordBatch.from_pylist([out.flush()], CHUNKS)

    spark = docs.sparkSession
    sorted_docs = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    chunks = sorted_docs.mapInArrow(run, CHUNKS_SQL)
    chunks.write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    # One row for each shard, that is, for each task that wrote.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    (
        spark.read.schema(CHUNKS_SQL).parquet(f"{path}/chunks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
        .select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"), "n_ids")
        .write.parquet(f"{path}/shards")
    )


def read_pieces(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """The pieces of all documents, decoded chunk by chunk: their ids, or with `digest` the crc32 of them.

    doc_id, shard, start (ids of all documents before), doc_tokens, piece_at, piece_len, and ids (binary, little-endian
    unsigned 32-bit) or crc.
    """
    value, kind = ("crc", pa.int64()) if digest else ("ids", pa.binary())
    names = [f.name for f in CHUNKS.field("pieces").type.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = {c: batch.column(c)[row].as_py() for c in ("shard", "n_ids", "kind", "planes")}
                data = memoryview(from_planes(chunk["planes"], chunk["n_ids"], chunk["kind"]).tobytes())
                pieces = batch.column("pieces").slice(row, 1).flatten()
                ends = (4 * np.cumsum(pieces.field("piece_len").to_numpy(), dtype=np.int64)).tolist()
                own = [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                found = [zlib.crc32(x) for x in own] if digest else [bytes(x) for x in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk["shard"]] * len(own), pa.int32()), *(pieces.field(n) for n in names), pa.array(found, kind)],
                    names=["shard", *names, value])

    chunks = spark.read.schema(CHUNKS_SQL).parquet(f"{path}/chunks").select("shard", "n_ids", "kind", "planes", "pieces")
    shards = spark.read.schema("shard int, start long, n_ids long").parquet(f"{path}/shards")
    found = chunks.mapInArrow(run, f"shard int, doc_id long, doc_start long, doc_tokens long, piece_at long, "
                                   f"piece_len int, {value} {'long' if digest else 'binary'}")
    # Shards are as many as tasks that wrote them.
    return found.join(F.broadcast(shards.select("shard", "start")), "shard").select(
        "doc_id", "shard", (F.col("start") + F.col("doc_start")).alias("start"), "doc_tokens", "piece_at", "piece_len", value)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids`: the documents put together again from their pieces."""
    pieces = F.sort_array(F.collect_list(F.struct("piece_at", "ids")))
    return (
        read_pieces(spark, path).groupBy("doc_id", "start", F.col("doc_tokens").alias("n_tokens"))
        .agg(F.aggregate(pieces, F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"))
    )


def _times(matrix: list[int], vector: int) -> int:
    out, at = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[at]
        vector, at = vector >> 1, at + 1
    return out


@functools.cache
def _zeros(power: int) -> list[int]:
    """What 2**power zero bytes do to a crc32, as a matrix over bits."""
    if power:
        half = _zeros(power - 1)
        return [_times(half, v) for v in half]
    shift = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
    for _ in range(3):
        shift = [_times(shift, v) for v in shift]
    return shift


def crc32_joined(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings after each other, from theirs and the second's length."""
    power = 0
    while length:
        if length & 1:
            first = _times(_zeros(power), first)
        length, power = length >> 1, power + 1
    return first ^ second


def document_crcs(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of the stored documents; pieces are decoded where they lie."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for parts in batch.column("parts").to_pylist():
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = crc32_joined(crc, p["crc"], 4 * p["piece_len"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in schema.names[:3]), pa.array(crcs, pa.int64())], schema=schema)

    pieces = stored(read_pieces(spark, path, digest=True).withColumn("n_tokens", F.col("doc_tokens")), "pieces")
    # Most documents are whole in one chunk; only the others' checksums are joined.
    whole = pieces.filter("piece_len = n_tokens").select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))
    parts = F.sort_array(F.collect_list(F.struct("piece_at", "piece_len", "crc"))).alias("parts")
    cut = pieces.filter("piece_len < n_tokens").groupBy("doc_id", "start", "n_tokens").agg(parts)
    return whole.unionByName(cut.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))
