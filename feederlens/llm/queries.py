"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from feederlens.llm import (
    alignment, contamination, extraction, idfiles, langid, line_dedup, minhash, oracle, packing, phrases, quality,
    sharding, tokens, trie,
)
from feederlens.llm.scratch import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=85)


def op6_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "whole_ratio", "n_chunks", "n_chunks_outside",
    )


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.through_files(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_line_dedup": op2_line_dedup,
        "op3_token_counts": op3_token_counts,
        "op4_contamination": op4_contamination,
        "op5_minhash": op5_minhash,
        "op6_phrases": op6_phrases,
        "op7_sharding": op7_sharding,
        "op8_html_extraction": op8_html_extraction,
        "op9_quality_rules": op9_quality_rules,
        "op10_langid": op10_langid,
        "op11_token_files": op11_token_files,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_alignment": op13_alignment,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
