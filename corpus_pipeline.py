"""A corpus pipeline: quality, toxicity, near copies, benchmark passages, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronopulse.llm import bpe, decontam, quality, simhash, toxicity
from chronopulse.llm._common import shared_folder


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _short_batches(spark: SparkSession) -> None:
    """Rows hold whole texts: batches of 1,000 rows instead of 10,000 keep the buffers of workers and executors small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (score under 0.7)."""
    _short_batches(spark)
    weights = quality.fit(_documents(spark, sf_dir), _labels(spark, sf_dir), lambda c: ~quality.held_out(c))
    return quality.keep_good(docs, weights)


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the toxicity classifier rejects (score of 0.5 or more)."""
    _short_batches(spark)
    weights = toxicity.fit(_documents(spark, sf_dir), _labels(spark, sf_dir), lambda c: ~toxicity.held_out(c))
    return toxicity.keep_harmless(docs, weights)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of each group of near copies (five-word shingles, similarity 0.8)."""
    _short_batches(spark)
    return simhash.deduplicate(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of the benchmark out of the texts."""
    _short_batches(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), mode="spans")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (packed, little-endian unsigned 32-bit) of every text, and decodes: whether they decode to it."""
    _short_batches(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_checked(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", "ids", "decodes")


STAGES = [
    ("quality", keep_good),
    ("toxicity", keep_harmless),
    ("near_copies", drop_near_copies),
    ("benchmark_passages", drop_benchmark_passages),
    ("byte_bpe", encode),
]

#: The classifiers are trained and the last stage runs a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read again."""
    docs = _documents(spark, sf_dir)
    root = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{root}/{k}_{name}")
            docs = spark.read.parquet(f"{root}/{k}_{name}")
    return docs
