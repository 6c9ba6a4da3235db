"""Corpus pipeline: five stages from documents to token files.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a
DataFrame with the columns of documents; the last one returns a row per document of the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from garimpo.llm import decontaminate, mixing, near_dups, quality, token_files
from garimpo.llm.common import BATCH_ROWS, settings, written


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects go."""
    return quality.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the document with the smallest id of each group stays, also where ids are null or repeated."""
    return near_dups.keep_every_component(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents whose words come from benchmark items in 5 % or more go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: each document as often as the mixture takes it."""
    return mixing.repeat_to_weights(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token files, described from what was written."""
    return token_files.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: The classifier and the tokenizer are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


#: Whole documents that a Python worker gets at once; each task holds them several times, in the JVM and in Python.
ROWS = 1000


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with settings(spark, {BATCH_ROWS: str(ROWS)}):
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)
