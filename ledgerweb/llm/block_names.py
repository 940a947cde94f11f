"""Exact duplicates by deterministic block naming.

Normalised texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered; a block's
number is its name. Adjacent names are then taken in pairs, the distinct pairs sorted and numbered from where the
last names ended, and so on until each document has one name (Karp, Miller and Rosenberg's naming). Equal texts
get equal names, and different texts never do: names stand for sorted distinct values, not for hashes.

A name finds its way back to its rows by the block's sha256. That the names of one digest are one is checked; a
digest shared by two different blocks stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm.common import ROW, has_files, keyed, stored

BLOCK = 4096
BLANKS = " \t\n\x0b\x0c\r"


class DigestClash(RuntimeError):
    pass


def normalised(text: str | Column) -> Column:
    """The text without the characters space, tab, line feed, vertical tab, form feed, carriage return; null is empty."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), BLANKS, "")


def _numbered(distinct: DataFrame, columns: list[str], first: int) -> DataFrame:
    """`name`: distinct values sorted within each of their partitions and numbered through; stored before any use."""
    return distinct.sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id() + F.lit(first))


def _blocks(texts: DataFrame, size: int) -> DataFrame:
    # Bytes, not characters: a block of a long text is found without walking through the text before it.
    data = F.col("norm").cast("binary").alias("data")
    last = F.greatest(F.ceil(F.octet_length("data") / F.lit(size)).cast("int"), F.lit(1)) - 1
    at = F.explode(F.sequence(F.lit(0), last)).alias("at")
    return texts.select(*ROW, data).select(*ROW, "data", at).select(
        *ROW, "at", F.substring(F.col("data"), F.col("at") * size + 1, F.lit(size)).alias("block"))


def identities(texts: DataFrame, size: int = BLOCK) -> DataFrame:
    """`row_file, row_pos, identity` for `texts(row_file, row_pos, norm)`: one name for each different `norm`."""
    blocks = _blocks(texts, size)
    digest = F.unhex(F.sha2(F.col("block"), 256)).alias("digest")
    distinct = blocks.select("block").distinct()
    names = stored(_numbered(distinct, ["block"], 0).select(digest, "name"), "block-names")
    if not names.groupBy("digest").count().filter("count > 1").isEmpty():
        raise DigestClash("two different blocks have one sha256")
    named = stored(
        blocks.select(*ROW, "at", digest).join(names, "digest").select(*ROW, F.col("at").cast("long").alias("at"), "name"), "level")
    done = None
    while True:
        # Documents with one name left are finished; the others go on.
        width = named.groupBy(*ROW).agg(F.max("at").alias("last"), F.max("name").alias("identity"))
        single = width.filter("last = 0").select(*ROW, "identity")
        more = named.join(width.filter("last > 0").select(*ROW), ROW, "left_semi")
        done = single if done is None else done.unionByName(single)
        half = F.col("at").bitwiseAND(F.lit(1)) == 0
        # An odd last name is paired with -1, which is no name.
        pairs = more.groupBy(*ROW, F.shiftright("at", 1).alias("at")).agg(
            F.max(F.when(half, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~half, F.col("name"))), F.lit(-1).cast("long")).alias("right"))
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            return stored(done, "identities")
        first = named.agg(F.max("name")).first()[0] + 1
        known = stored(_numbered(pairs.select("left", "right").distinct(), ["left", "right"], first), "pair-names")
        named = stored(pairs.join(known, ["left", "right"]).select(*ROW, "at", "name"), "level")


def exact_duplicates(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """The row's key, `doc_id, keep_id, group_size, kept, text_sha256` for every row of `docs(doc_id, text)`, dropped ones too.

    Texts are equal when they are identical without blanks (space, tab, line feed, vertical tab, form feed, carriage return); a
    null text counts as empty. Of equal texts the row with the most characters in the original stays, then the one with the
    smallest doc_id (null last), then the first one stored. Other columns are ignored; no documents give no rows.
    """
    if not has_files(docs):  # keyed twice, by files' places
        docs = stored(docs.select("doc_id", "text"), "documents")
    texts = keyed(docs, normalised("text").alias("norm"))
    identity = identities(texts, size)
    facts = keyed(
        docs, F.col("doc_id").cast("long").alias("doc_id"), F.char_length(F.coalesce(F.col("text"), F.lit(""))).alias("length"),
        F.sha2(normalised("text"), 256).alias("text_sha256"))
    rows = stored(facts.join(identity, ROW), "rows")
    head = F.min(F.struct((-F.col("length")).alias("short"), F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW)).alias("head")
    groups = stored(rows.groupBy("identity").agg(head, F.count(F.lit(1)).alias("group_size")), "groups")
    same = [F.col(f"head.{c}").eqNullSafe(F.col(c)) for c in ROW]
    return rows.join(groups, "identity").select(
        *ROW, "doc_id", F.col("head.doc_id").alias("keep_id"), "group_size", (same[0] & same[1]).alias("kept"), "text_sha256")
