"""A corpus pipeline over ``documents``: each stage's rows are written and read by the next.

All stages but the last return the columns they were given, so tables with more columns pass through. Null and
empty texts leave at the first stage; an empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cdcmart.llm import bpe, decontam, jaccard, langid, secretscan
from cdcmart.llm.common import run_folder, saved
from cdcmart.llm.queries import tokenizer_file


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus: rejected are those without a letter and those the network cannot place."""
    return langid.known_only(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that links of 0.8 or more join: the one with the smallest id."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked; examples that several owners have copied stay."""
    return secretscan.masked(docs, keep_copied=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, as number and digest, and the digest of their decoding."""
    return bpe.digests(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("benchmark", without_benchmark),
    ("secrets", secrets_masked),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = run_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), folder, name)
    return docs


# The language stage is a trained network: there is no SQL for the rows.
ORACLE_SQL = None
