"""Documents packed into windows of a fixed number of tokens, best fit decreasing.

Overlong documents are first cut into full windows and a rest. Pieces are dealt evenly into shards of bounded size,
each packed by one task: in order of falling length, a piece goes into the open window with the least room
that still holds it, found by a segment tree over remaining room. Every shard leaves a few windows
partly filled at its end, so the padding of all shards together stays a small share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.llm.common import stored, text_batches, texts_of
from ledgerweb.llm.token_ids import encoder

WINDOW = 4096
SHARD_PIECES = 1 << 15
BATCH_BYTES = 4 << 20
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("ids", pa.binary())])


class OpenWindows:
    """Open windows by remaining room; a segment tree over rooms 0..capacity tells where there are any."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.by_room: dict[int, list[int]] = {}

    def _count(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, window: int, room: int) -> None:
        if room:
            self.by_room.setdefault(room, []).append(window)
            self._count(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The tightest window with at least `length` room, taken out; None where there is none."""
        node = self.leaves + length
        if not self.tree[node]:
            # Up to the first subtree to the right that holds a window, then down to its leftmost leaf.
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return self.by_room[room].pop(), room


def best_fit(lengths: list[int], capacity: int = WINDOW) -> list[tuple[int, int]]:
    """Window and offset of each piece; `lengths` fall."""
    windows, opened, places = OpenWindows(capacity), 0, []
    for length in lengths:
        found = windows.take(length)
        if found is None:
            found = opened, capacity
            opened += 1
        window, room = found
        places.append((window, capacity - room))
        windows.put(window, room - length)
    return places


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """The pieces of `docs(doc_id, text)`: full windows and a rest of each, with their ids if wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in text_batches(batches, BATCH_BYTES):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch)), strict=True):
                ids = np.append(ids, np.array([end_id], dtype="<u4"))
                for start in range(0, len(ids), window):
                    raw = ids[start:start + window].tobytes()
                    rows.append({"doc_id": doc_id, "start": start, "length": len(raw) // 4, "ids_crc32": zlib.crc32(raw),
                                 "doc_tokens": len(ids), "ids": raw if keep_ids else None})
            yield pa.RecordBatch.from_pylist(rows, PIECES)

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return wanted.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def place(pieces: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`pieces` with `sequence_id` (0, 1, ... over all) and `offset`; `pieces` has a `length` of 1 to `window`.

    Pieces are read from a stored table and dealt by their place in it, so neither a hot document nor
    repeated rows make a shard large.
    """
    total = pieces.count()
    shards = max(1, -(-total // shard_pieces))
    columns = pieces.columns

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        places = best_fit(table.column("length").to_pylist(), window)
        return table.append_column("window", pa.array([w for w, _ in places], pa.int64())).append_column(
            "offset", pa.array([o for _, o in places], pa.int64()))

    # In turn: the first rows of all partitions would otherwise meet in the first shards.
    turn = F.monotonically_increasing_id()
    dealt = pieces.withColumn("shard", F.pmod(turn + F.shiftright(turn, 33) * 7919, F.lit(shards)).cast("long"))
    packed = stored(dealt.groupBy("shard").applyInArrow(run, f"{_ddl(dealt)}, window long, offset long"), "packed")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    first = (
        packed.groupBy("shard").agg((F.max("window") + 1).alias("windows"))
        .select("shard", F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("first"))
    )
    return packed.join(first, "shard").select(
        *columns, (F.col("first") + F.col("window")).alias("sequence_id"), "offset")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null texts count as empty and give the end id alone. Repeated ids and rows are documents of their own. Other
    columns are ignored; no documents give no rows. Offsets run from 0 without gaps in every window.
    """
    pieces = cut_documents(docs, tokenizer, end_id, window, keep_ids)
    return place(stored(pieces if keep_ids else pieces.drop("ids"), "pieces"), window)


def sequences(packed: DataFrame, pad_id: int = 0, window: int = WINDOW) -> DataFrame:
    """`sequence_id, n_tokens, ids`: the windows' ids (binary), padded to `window`; `packed` holds `ids`."""
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("offset", "ids"))), F.lit(b""),
                         lambda all_ids, p: F.concat(all_ids, p["ids"]))
    little = "".join(f"{pad_id:08x}"[i:i + 2] for i in (6, 4, 2, 0))
    pad = F.unhex(F.repeat(F.lit(little), (F.lit(window) - F.col("n_tokens")).cast("int")))
    return (
        packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
        .withColumn("ids", F.concat("ids", pad))
    )
