"""Corpus pipeline: language ID, near-dedup, long-repeat removal, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoflow.llm import crf, packing, runlength, simhash
from tempoflow.llm.common import read, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of no language: no text, or not one letter."""
    return crf.keep_identified(docs, crf.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id. Links are fingerprints of three-word shingles at 3 or fewer differing bits.

    Rows with a null id stay, an empty table gives no rows; see :func:`tempoflow.llm.simhash.keep_first`.
    """
    return simhash.keep_first(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts long repeated stretches out of texts; a document of which nothing is left goes, ``n_chars`` is counted anew."""
    cut = runlength.without_repeats(docs).where("text is null or text <> ''")
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left in sequences of at most 1024 tokens; see :func:`tempoflow.llm.packing.pack`."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", pack),
]

ORACLE_SQL = None  # hashes, a trained model and a tokenizer are beyond SQL; tests/llm holds the brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
