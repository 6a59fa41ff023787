"""From raw documents to token ids in five stages.

A document whose text is null, empty or blank fails the quality rules and goes with the
first stage; repeated rows and ties are settled as each stage's operator says; an empty
table gives an empty one after every stage; further columns are kept up to the last.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and
read again as the next one's input, so an executor lost later costs a reread and no more.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.llm import decontaminate, line_dedup, pieces, quality, simhash  # noqa: E402
from tradewind.session import configure, workspace  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go, then documents that are rejected."""
    return quality.clean(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that a document with a smaller id has as well."""
    return line_dedup.clean(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_chunks of each document."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", remove_benchmark),
    ("sentencepiece", encode_pieces),
]

# Fingerprint majorities and piece segmentations are beyond SQL; tests compare the result
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` of ``sf_dir``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = workspace(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
