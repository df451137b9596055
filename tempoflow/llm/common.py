"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoflow.session import shuffle_partitions, spread_if_narrow, stage_path

TEXT_KEY = ("t1", "t2")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder; one that lies in fewer splits than there are cores is dealt out anew."""
    return spread_if_narrow(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, *keys: str) -> DataFrame:
    """As :func:`staged`, in buckets of ``keys``, so that joins on them leave the rows where they lie."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd").option("path", stage_path(spark, label))
    writer.bucketBy(shuffle_partitions(spark), *keys).saveAsTable(name)
    return spark.table(name)


def text_key(text: str = "text") -> list:
    """128 bits that stand for a text: equal texts meet, and different ones never do for any practical corpus."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(0x51ED270B), F.col(text), F.length(text)).alias("t2")]


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each different non-null text once with its number of rows, in buckets of its key.

    The count is combined before the shuffle, so a text that a third of the rows share moves once per task.
    """
    keyed = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).select("text", *text_key())
    grouped = keyed.groupBy(*TEXT_KEY).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    return bucketed(grouped, "texts", *TEXT_KEY)


def back_to_rows(docs: DataFrame, results: DataFrame, empty: dict, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Results per different text joined to every row by the text's key; null texts get the columns of ``empty``.

    The side with one row per text is moved by a hash of its key, so that adaptive execution may split a hot text.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), *text_key(text), F.col(text).isNull().alias("no_text"))
    sides = results.repartition(F.xxhash64(*TEXT_KEY))
    joined = rows.join(sides, list(TEXT_KEY), "left")
    values = [F.when(F.col("no_text"), F.lit(value)).otherwise(F.col(name)).alias(name) for name, value in empty.items()]
    return joined.select("doc_id", *values)
