"""A corpus pipeline: every stage works on all documents that the stage before it kept.

Language ID, exact dedup, near dedup, removal of long repeats, packing. Each stage's result is written as Parquet and read
again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import scratch_path
from ledgerweb.llm import block_names, lang_profiles, packing, simhash_bk, suffix_dedup
from ledgerweb.llm.common import ROW, keyed, prepare_workers, remainder
from ledgerweb.llm.queries import END_ID, WORD_BPE, table


def _whole_rows(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """Rows with their keys and, under numbered names, the given columns: no name of theirs can clash."""
    names = [f"column_{i}" for i in range(len(columns))]
    return keyed(docs, *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)]), names


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined: null texts and texts without letters are rejected."""
    prepare_workers(spark)
    profiles = lang_profiles.learn(docs.filter(remainder("doc_id", 5) != 0))
    names = ["text" if c.lower() == "text" else f"column_{i}" for i, c in enumerate(docs.columns)]
    found = lang_profiles.identify(docs.toDF(*names), profiles)
    kept = found.filter(F.col("lang_pred") != lang_profiles.UNDETERMINED)
    return kept.select(*names).toDF(*docs.columns)


def _only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    rows, names = _whole_rows(docs, *docs.columns)
    return rows.join(chosen.select(*ROW), ROW, "left_semi").select(*names).toDF(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    prepare_workers(spark)
    return _only(docs, block_names.exact_duplicates(docs).filter("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    prepare_workers(spark)
    return _only(docs, simhash_bk.near_duplicates(docs).filter("keep"))


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without long passages that occur elsewhere too; `n_chars`, if there, follows the text.

    Passages of `suffix_dedup.PASSAGE` bytes: those of over 50 words are often shorter than the operator's own length.
    """
    prepare_workers(spark)
    lower = [c.lower() for c in docs.columns]
    whole = {c: f"column_{i}" for i, (c, low) in enumerate(zip(docs.columns, lower, strict=True)) if low not in ("text", "n_chars")}
    kept = suffix_dedup.remove_repeats(
        docs, suffix_dedup.PASSAGE, "kept_text", carried=[F.col(f"`{c}`").alias(n) for c, n in whole.items()])
    columns = []
    for name, low in zip(docs.columns, lower, strict=True):
        value = F.col("kept_text") if low == "text" else F.char_length("kept_text").cast(docs.schema[name].dataType) if low == "n_chars" else F.col(whole[name])
        columns.append(value.alias(name))
    return kept.select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 tokens."""
    prepare_workers(spark)
    return packing.pack(docs, WORD_BPE, END_ID)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
