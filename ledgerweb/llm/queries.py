"""The registered queries of this package: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import scratch_path
from ledgerweb.llm import (
    backoff_lm, block_names, byte_bpe, fill_middle, lang_profiles, packing, pca_tiles, prefix_trie, simhash_bk, suffix_dedup, token_store,
    uniform_topk, url_filter,
)
from ledgerweb.llm.common import ROW, prepare_workers, remainder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark, sf_dir):
    judged = url_filter.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_token_store(spark, sf_dir):
    path = scratch_path(spark, "ids")
    token_store.write_ids(table(spark, sf_dir, "documents"), path, WORD_BPE, END_ID)
    return token_store.document_crcs(spark, path)


def op3_block_names(spark, sf_dir):
    found = block_names.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_lang_profiles(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 5) == 0)
    profiles = lang_profiles.learn(docs.filter(~F.col("held_out")))
    return lang_profiles.identify(docs, profiles, ["doc_id", "held_out"])


def op5_uniform_topk(spark, sf_dir):
    return uniform_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, END_ID)


def op7_backoff_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 10) == 0)
    return backoff_lm.score(docs)


def op8_suffix_dedup(spark, sf_dir):
    """At 400 bytes as agreed; `n_repeated` is what the same operator would remove at 256, where passages of over 50 words are found too."""
    docs = table(spark, sf_dir, "documents")
    found = suffix_dedup.remove_repeats(docs, result="kept_sha256")
    shorter = suffix_dedup.remove_repeats(docs, suffix_dedup.PASSAGE).select(*ROW, F.col("n_removed").alias("n_repeated"))
    return found.join(shorter, ROW).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated")


def op9_byte_bpe(spark, sf_dir):
    return byte_bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN, digest=True)


def op10_simhash(spark, sf_dir):
    found = simhash_bk.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_bk.hexadecimal().alias("fingerprint"), "component_id")


def op11_fill_middle(spark, sf_dir):
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_prefix_trie(spark, sf_dir):
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_openings(turns, every=20, most=4))


def op13_pca_tiles(spark, sf_dir):
    return pca_tiles.near_duplicates(table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn for fn in (
        op1_url_filter, op2_token_store, op3_block_names, op4_lang_profiles, op5_uniform_topk, op6_packing, op7_backoff_lm,
        op8_suffix_dedup, op9_byte_bpe, op10_simhash, op11_fill_middle, op12_prefix_trie, op13_pca_tiles, pipeline,
    )
}
