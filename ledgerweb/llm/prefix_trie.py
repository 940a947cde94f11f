"""The prefix trie of conversations, by ROLLUP over columns of turn ids.

Every different turn (role and text) gets a number. A conversation's numbers stand in columns, `WIDTH` of them to a row;
one ROLLUP over those columns then groups all its prefixes at once, and `grouping_id` tells a group's depth. Longer
conversations go on in further rows, column blocks that are grouped by the name of the node where the block before
ended: the SHA-256 of that node's path. So all blocks of all conversations are one ROLLUP, however long they are.

What concerns whole subtrees needs no walk over the tree. A conversation is the smallest member of its nodes from some depth
on, and of none above; that depth comes from a first ROLLUP. In a second one each conversation adds, to all its nodes, the words
that it repeats from there down, and a leaf if it is the smallest member of one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.functions.ordered import running
from ledgerweb.llm.common import stored

WIDTH = 8
PIECE_BYTES = 1 << 20
ROOT = b""
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _hashed(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(conversations: DataFrame) -> DataFrame:
    """`conv_id, pos, id, words` of every turn: its place from 1, its number and how many words its text has.

    Turns are ordered by `turn` (null first), equal ones by the SHA-256 of role and text. A null role or text counts as
    empty. Rows without conv_id belong to no conversation. Numbers stand for one role and text each.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        _hashed(F.char_length(role).cast("string"), F.lit(":"), role, text).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    ).filter("conv_id IS NOT NULL")
    # A conversation may be too long for one task: its places are counted over range partitions.
    placed = stored(
        running(slim, ["conv_id"], [F.asc_nulls_first("turn"), F.col("digest")], sums={"pos": F.lit(1).cast("long")}, inclusive=True)
        .select("conv_id", "pos", "digest", "words"), "placed")
    ids = stored(placed.select("digest").distinct().select("digest", F.monotonically_increasing_id().alias("id")), "turn-ids")
    return stored(placed.join(ids, "digest").select("conv_id", "pos", "id", "words"), "turns")


def with_openings(turns: DataFrame, every: int, most: int) -> DataFrame:
    """`turns` rebuilt so that groups of `every` conversations share openings; `pos, id, words` null for one without turns.

    The first h turns of conversation c give way to those of conversation c - c % every, with h = crc32(c) % most. That
    conversation's fewer or missing turns leave no gap.
    """
    heads = (
        turns.filter((F.col("pos") < most) & (F.col("conv_id") % every == 0)).groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("heads"))
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    convs = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    taken = F.coalesce(F.slice("heads", F.lit(1), F.col("h")), F.array().cast("array<struct<pos:bigint,id:bigint,words:bigint>>"))
    opened = stored(convs.join(heads, "base", "left").select("conv_id", "h", taken.alias("heads")), "openings")
    own = (
        turns.join(opened.select("conv_id", "h", F.size("heads").alias("taken")), "conv_id").filter("pos > h")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "words")
    )
    # The outer form keeps conversations that take nothing over; a row without a turn only says that there is one.
    return own.unionByName(opened.select("conv_id", F.inline_outer("heads")).select("conv_id", "pos", "id", "words"))


def _names(kind: str) -> list[str]:
    return [f"{kind}{i}" for i in range(WIDTH)]


def blocks(turns: DataFrame) -> DataFrame:
    """Rows of `WIDTH` turns: `conv_id, block, t0.., w0.., key, before, last`.

    `key` names the node where the block before ended, `before` counts the words until there, `last` marks a
    conversation's last row.
    """
    place = F.coalesce(F.col("pos"), F.lit(0)) - 1
    block = F.when(place < 0, F.lit(0).cast("long")).otherwise(F.floor(place / WIDTH).cast("long"))
    rows = turns.select("conv_id", block.alias("block"), F.pmod(place, F.lit(WIDTH)).alias("slot"), "id", "words")
    wide = rows.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("id"))).alias(n) for i, n in enumerate(_names("t"))],
        *[F.coalesce(F.max(F.when(F.col("slot") == i, F.col("words"))), F.lit(0)).alias(n) for i, n in enumerate(_names("w"))])
    kinds = ", ".join(f"{n} long" for n in ["conv_id", "block", *_names("t"), *_names("w")])
    sorted_ = wide.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return stored(sorted_.mapInArrow(_chained, f"{kinds}, key binary, before long, last boolean"), "blocks")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and block get their key; one row is held back to see whether its conversation goes on."""
    held, key, before = None, ROOT, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        block = batch.column("block").to_numpy()
        turn_columns = [batch.column(n) for n in _names("t")]
        words = np.sum([batch.column(n).to_numpy() for n in _names("w")], axis=0)
        keys, befores = [ROOT] * len(conv), np.zeros(len(conv), dtype=np.int64)
        goes_on = np.append(block[1:] > 0, False)
        for at in np.flatnonzero((block > 0) | goes_on | (np.arange(len(conv)) == len(conv) - 1)).tolist():
            if block[at] == 0:
                key, before = ROOT, 0
            keys[at], befores[at] = key, before
            # What the next row would begin with; a row that isn't full has no next one.
            ids = [c[at].as_py() for c in turn_columns]
            key = hashlib.sha256(",".join([key.hex().upper(), *map(str, ids)]).encode()).digest()
            before += int(words[at])
        columns = [*batch.columns, pa.array(keys, pa.binary()), pa.array(befores)]
        made = pa.Table.from_arrays(columns, names=[*batch.schema.names, "key", "before"])
        whole = pa.concat_tables([held, made]).combine_chunks() if held is not None else made
        following = whole.column("block").to_numpy()[1:] > 0
        held = whole.slice(whole.num_rows - 1)
        yield from whole.slice(0, whole.num_rows - 1).append_column("last", pa.array(~following)).to_batches()
    if held is not None:
        yield from held.append_column("last", pa.array([True])).to_batches()


def _name(turns: list[Column]) -> Column:
    """The name of the node that lies below `key` by the given turns; nulls are left out."""
    return _hashed(F.concat_ws(",", F.hex("key"), *[t.cast("string") for t in turns]))


def _rollup(rows: DataFrame, measures: str) -> DataFrame:
    """All prefixes of all blocks with the given aggregates: `key, t0.., level, depth` and those."""
    turns = ", ".join(_names("t"))
    found = rows.sparkSession.sql(
        f"SELECT key, block, {turns}, {WIDTH} - bit_count(grouping_id()) AS level, {measures} "
        f"FROM {{rows}} GROUP BY key, block, ROLLUP ({turns})", rows=rows)
    # A block's own top is the node where the one before ended, but for the root; a null turn is the end of a shorter conversation.
    there = F.when(F.col("level") == 0, F.col("block") == 0).otherwise(F.array(*_names("t"))[F.col("level") - 1].isNotNull())
    return found.filter(there).withColumn("depth", F.col("block") * WIDTH + F.col("level"))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """`name, ends_sha256`: the hash of the ascending, comma-joined conv_ids of each name.

    Ids are joined into pieces of bounded length over range partitions, which cut a name with very many; the pieces of a name
    are then hashed one after another without holding them.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, text, size = None, None, [], 0
        for batch in batches:
            out = []
            for own, conv in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if text and (own != name or size > PIECE_BYTES):
                    out.append((name, first, ",".join(text)))
                    text, size = [], 0
                if not text:
                    name, first = own, conv
                text.append(str(conv))
                size += len(text[-1]) + 1
            yield _batch(out, [("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
        if text:
            yield _batch([(name, first, ",".join(text))], [("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, kinds = None, None, [("name", pa.binary()), ("ends_sha256", pa.string())]
        for batch in batches:
            out = []
            for own, ids in zip(batch.column("name"), batch.column("ids"), strict=True):
                own = own.as_py()
                if state is None or own != name:
                    if state is not None:
                        out.append((name, state.hexdigest()))
                    name, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
            yield _batch(out, kinds)
        if state is not None:
            yield _batch([(name, state.hexdigest())], kinds)

    joined = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    joined = joined.mapInArrow(pieces, "name binary, first long, ids string")
    return joined.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashes, "name binary, ends_sha256 string")


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, (_, kind) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def trie(turns: DataFrame) -> DataFrame:
    """One row for each different prefix of the conversations in `turns(conv_id, pos, id, words)`, the empty one included.

    `conv_id` (the smallest member), `depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`. A member
    is a conversation that starts with the prefix. `n_leaves` counts childless nodes at or below, `saved_tokens` sums
    (n_convs - 1) * words of the last turn over the nodes at or below, `ends_sha256` is the hash of the ids of the members that end
    here. A row whose `pos` is null stands for a conversation without turns, which is a member of the root alone. Without
    conversations there is no node.
    """
    rows = blocks(turns)
    filled = sum(F.col(t).isNotNull().cast("int") for t in _names("t"))
    reach = F.col("block") * WIDTH + filled + (~F.col("last")).cast("int")
    shapes = _rollup(rows.select("key", "block", *_names("t"), "conv_id", reach.alias("reach")), "min(conv_id) AS conv_id, max(reach) AS reach")
    # From which depth on a conversation is the smallest member of its nodes, and whether the last of them is a leaf.
    own = stored(shapes.groupBy("conv_id").agg(
        F.min("depth").alias("since"), F.max((F.col("depth") == F.col("reach")).cast("long")).alias("leaf")), "since")
    repeated = sum(
        F.when(F.col("since").isNull() | (F.col("block") * WIDTH + i + 1 < F.col("since")), F.col(w)).otherwise(F.lit(0))
        for i, w in enumerate(_names("w")))
    shared = stored(
        rows.join(own, "conv_id", "left").groupBy("conv_id")
        .agg(F.sum(repeated).alias("repeated"), F.coalesce(F.max("leaf"), F.lit(0)).alias("leaf")), "repeated")
    # Words that a conversation repeats at or below its node at each level of the block.
    above, below = F.col("before"), []
    for w in _names("w"):
        below.append(F.greatest(F.lit(0).cast("long"), F.col("repeated") - above).alias(f"s{len(below)}"))
        above = above + F.col(w)
    sums = ", ".join(f"sum(s{i}) AS s{i}" for i in range(WIDTH))
    found = _rollup(rows.join(shared, "conv_id").select("key", "block", *_names("t"), "conv_id", "leaf", *below),
                    f"min(conv_id) AS conv_id, count(*) AS n_convs, sum(leaf) AS n_leaves, {sums}")
    turn_ids = [F.col(t) for t in _names("t")]
    upper = [F.when(F.col("level") - 1 > i, t) for i, t in enumerate(turn_ids)]
    nodes = stored(found.select(
        F.when(F.col("level") == 0, F.col("key")).otherwise(_name(turn_ids)).alias("name"),
        F.when(F.col("level") == 1, F.col("key")).when(F.col("level") > 1, _name(upper)).alias("parent"),
        "conv_id", "depth", "n_convs", "n_leaves",
        F.array(*[f"s{i}" for i in range(WIDTH)])[F.greatest(F.col("level"), F.lit(1)) - 1].alias("saved_tokens")), "nodes")
    ends = rows.filter("last").select(F.when(filled == 0, F.col("key")).otherwise(_name(turn_ids)).alias("name"), "conv_id")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(children, "name", "left").join(_end_hashes(ends), "name", "left").join(parents, "parent", "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    )
