"""From raw documents to token ids: quality, exact copies, near copies, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the
columns of documents. A stage of ``STAGES`` writes its result as Parquet to the folder that executors share and reads it
again, so that a lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import bpe, decontam, exact, jaccard, quality
from spendlens.llm.batches import join_filter, key_filter, small_batches
from spendlens.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the scorers call poor or toxic."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id.

    Rows go by doc_id and text, so that another text under the same id stays. Only documents that may be among those to
    go are joined with them; the others pass without a shuffle.
    """
    gone = jaccard.spare_rows(docs).select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"))
    gone = materialize(gone, "gone")
    places = key_filter(gone, "gone_id")
    sure = join_filter(docs, F.col("doc_id"), places, "left_anti")
    maybe = join_filter(docs, F.col("doc_id"), places)
    same = (maybe["doc_id"] == gone["gone_id"]) & (F.xxhash64(maybe["text"]) == gone["gone_mark"])
    return sure.unionAll(maybe.join(gone, same, "left_anti"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def stored(name: str, stage: Callable) -> tuple[str, Callable]:
    """``stage`` done and stored before it returns, all of it in small batches.

    What a stage only plans runs with its caller's settings: 10,000 whole texts in one batch, held by the JVM and by each
    Python worker.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))

    return name, run_stage


STAGES = [
    stored("quality classifier", quality_stage),
    stored("exact dedup", exact_stage),
    stored("n-gram Jaccard join", near_stage),
    stored("benchmark decontamination", benchmark_stage),
    stored("byte-level BPE", encode_stage),
]

#: The classifier is trained and the ids are a tokenizer's: no SQL says what ``run`` returns.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
