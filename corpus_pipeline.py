"""From raw documents to packed training sequences.

Each stage applies one operator to all that the stage before kept. Stages hand
on the columns of ``documents``; the last gives the pieces of the sequences.
Where an operator changes the text, ``n_chars`` follows it.

Stages set the session's rows per Arrow batch to ``ROWS_PER_BATCH``, which
``run`` sets back: whole texts in batches of Spark's ten thousand rows take
memory on both sides of the pipe, twice where a batch carries the row beside
its text. A stage called by itself leaves its frame to be run with that setting.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from feederlens.llm import contamination, line_dedup, minhash, packing, quality
from feederlens.llm.scratch import Scratch, table

ROWS_PER_BATCH = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(stage: Callable) -> Callable:
    @wraps(stage)
    def set_then_run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(_BATCH, ROWS_PER_BATCH)
        return stage(spark, docs, sf_dir)

    return set_then_run


@in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the compression bands go."""
    return quality.keep_good(docs)


@in_small_batches
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents have stay in one of them."""
    cleaned = line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(docs.columns)


@in_small_batches
def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_one(docs)


@in_small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return contamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences, with the token ids of each piece."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("minhash", dedup_near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Compression ratios, signatures and tokens are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    before = spark.conf.get(_BATCH)
    try:
        for name, stage in STAGES:
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(_BATCH, before)
    return docs
