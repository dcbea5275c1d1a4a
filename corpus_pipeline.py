"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents, the
last one the pieces of packed sequences. Between stages the documents are
written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locuspark.llm import exact_dedup, language, mixing, near_dedup, packing
from locuspark.llm.common import documents, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those too far from all known languages go."""
    return language.recognised(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact_dedup.keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group, the document with the smallest id."""
    return near_dedup.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the sources' targets; a repeated document is a repeated row."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: Languages, signatures, the flow and tokens are beyond SQL; tests compare the first three stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
