"""Byte-level BPE where every distinct word of the corpus is encoded once.

Texts are split into pre-tokens by the pattern. A block keeps its pre-tokens as positions in its own word list and
sends the words to buckets by hash; a bucket encodes each distinct word once, however many blocks ask, and
answers with its ids. A block puts the ids at its positions, document by document; positions are number lists in the
block's body, not rows. Decoding looks each id up in a list of the tokens' bytes, one entry for each rank, which every worker
reads from the ranks file; neither step is a join of DataFrames.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm import blocks
from ledgerweb.llm.common import dump, load, ranges, texts_of

def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


_KNOWN: dict[tuple, object] = {}


def _encoding(path: str, pattern: str):
    if (path, pattern) not in _KNOWN:
        import tiktoken

        _KNOWN[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _KNOWN[path, pattern]


def _table(path: str) -> list[bytes]:
    if path not in _KNOWN:
        _KNOWN[path] = token_bytes(read_ranks(path))
    return _KNOWN[path]


def planes(numbers: np.ndarray) -> list[np.ndarray]:
    """The low, middle and high bytes of numbers below 2**32: alike bytes compress better together."""
    octets = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return [np.ascontiguousarray(row) for row in octets]


def unplaned(rows: list[np.ndarray]) -> np.ndarray:
    return np.ascontiguousarray(np.stack(rows).T).view("<u4").reshape(-1)


def split_block(batch, pattern, buckets: int) -> tuple[bytes, dict[int, bytes], int]:
    """A block's positions as its body, and its words by bucket."""
    numbers: defaultdict[str, int] = defaultdict(itertools.count().__next__)
    lengths, found = [], []
    for text in texts_of(batch):
        words = pattern.findall(text)
        lengths.append(len(words))
        found.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
    positions = np.concatenate([*found, np.zeros(0, np.int64)])
    words = [w.encode() for w in numbers]
    order, first = blocks.by_bucket(np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words)), buckets)
    # Words are renumbered by falling frequency, which keeps the high planes empty; `place` leads to their order by bucket.
    often = np.argsort(-np.bincount(positions, minlength=len(words)), kind="stable")
    renamed = np.empty(len(words), dtype=np.int64)
    renamed[often] = np.arange(len(words))
    place = np.empty(len(words), dtype=np.int64)
    place[renamed[order]] = np.arange(len(words))
    body = dump(np.array(lengths, dtype=np.int64), place.astype("<u4"), *planes(renamed[positions]), level=3)
    parts = {}
    for bucket in range(buckets):
        if len(own := order[first[bucket]:first[bucket + 1]]):
            chosen = [words[i] for i in own]
            parts[bucket] = dump(np.array([len(w) for w in chosen], dtype="<u4"),
                                 np.frombuffer(b"".join(chosen), np.uint8), level=3)
    return body, parts, len(positions)


def words_of(data: bytes) -> list[bytes]:
    lengths, joined = load(data)
    ends, raw = np.cumsum(lengths).tolist(), joined.tobytes()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def encode_words(lists: list[bytes], encode) -> list[bytes]:
    """Ids of the words of every list; a word that several lists hold is encoded once."""
    known: dict[bytes, bytes] = {}
    answers = []
    for data in lists:
        found = []
        for word in words_of(data):
            ids = known.get(word)
            if ids is None:
                ids = known[word] = np.array(encode(word.decode()), dtype="<u4").tobytes()
            found.append(ids)
        counts = np.array([len(i) // 4 for i in found], dtype="<u4")
        answers.append(dump(counts, *planes(np.frombuffer(b"".join(found), "<u4")), level=3))
    return answers


def joined_ids(body: bytes, answers: dict[int, bytes]) -> Iterator[np.ndarray]:
    """The ids of each document of a block."""
    lengths, place, *rows = load(body)
    positions = place[unplaned(rows)] if len(rows[0]) else np.zeros(0, np.int64)
    counts, ids = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
    for bucket in sorted(answers):
        n, *low = load(answers[bucket])
        counts.append(n)
        ids.append(unplaned(low))
    count, flat = np.concatenate(counts).astype(np.int64), np.concatenate(ids)
    first = np.cumsum(count) - count
    at = 0
    for n in lengths.tolist():
        own = positions[at:at + n]
        at += n
        yield flat[ranges(first[own], count[own])]


def encode(docs: DataFrame, ranks_path: str, pattern: str, digest: bool = False) -> DataFrame:
    """Ids of every whole text of `docs(doc_id, text)`, as the tiktoken library would give.

    `doc_id, n_tokens` and `ids` (binary, little-endian unsigned 32-bit) or, with `digest`, the sha256 of the ids and of
    the bytes that they decode to (`ids_sha256`, `decoded_sha256`). Null texts count as empty and give no ids. Repeated ids and
    rows give a row each; other columns are ignored; no documents give no rows. Texts may have any length.
    """
    buckets = blocks.bucket_count(docs)
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def make(batch):
        import regex

        return split_block(batch, regex.compile(pattern), buckets)

    def merge(lists, _):
        return encode_words(lists, _encoding(ranks_path, pattern).encode_ordinary)

    def each(keys: pa.Table, body: bytes, answers: dict[int, bytes]) -> pa.Table:
        found = list(joined_ids(body, answers))
        columns = {"doc_id": keys.column("doc_id").combine_chunks(), "n_tokens": pa.array([len(i) for i in found], pa.int64())}
        if digest:
            table = _table(ranks_path)
            columns["ids_sha256"] = pa.array([hashlib.sha256(i).hexdigest() for i in found], pa.string())
            columns["decoded_sha256"] = pa.array([hashlib.sha256(decoded(i, table)).hexdigest() for i in found], pa.string())
        else:
            columns["ids"] = pa.array([i.tobytes() for i in found], pa.binary())
        return pa.table(columns)

    held = blocks.build(wanted, make, "words")
    replies = blocks.exchange(blocks.sent(held), merge)
    rest = "ids_sha256 string, decoded_sha256 string" if digest else "ids binary"
    return blocks.finish(blocks.answered(held.select("block", "keys", "body"), replies), each, f"doc_id long, n_tokens long, {rest}")


def decoded(ids: np.ndarray, table: list[bytes]) -> bytes:
    """The bytes of ids, looked up in the token-byte table."""
    return b"".join(map(table.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """`doc_id, data`: the bytes of the `ids` of each row; null ids give no bytes, an id outside the table an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(ranks_path)
        for batch in batches:
            data = [decoded(np.frombuffer(i or b"", "<u4"), table) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")
