"""Uniform samples of fixed size: the k rows with the smallest random key.

Bottom-k of a union equals bottom-k of the bottom-ks, so the sample is computed per task, merged, and kept across
micro-batches without ever seeing the whole input in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoflow import schema as S

KEY = "sample_key"


def random_key(seed: int | None = None) -> Column:
    """A fresh random key per row, as text of fixed length so that it sorts evenly."""
    return F.md5((F.rand() if seed is None else F.rand(seed)).cast("string"))


def hashed_key(identity: str = "seq", seed: int = 0) -> Column:
    """A key that depends only on the row identity: the same sample on every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(identity).cast("string")))


def keyed(df: DataFrame, key: Column | None = None) -> DataFrame:
    return df.withColumn(KEY, random_key() if key is None else key)


def bottom_k(df: DataFrame, k: int = S.RESERVOIR_SIZE, tie: tuple[str, ...] = ()) -> DataFrame:
    return df.orderBy(KEY, *tie).limit(k)


def reservoir_sample(
    df: DataFrame, k: int = S.RESERVOIR_SIZE, key: Column | None = None, tie: tuple[str, ...] = ()
) -> DataFrame:
    return bottom_k(keyed(df, key), k, tie).drop(KEY)


def merge(previous: DataFrame, batch: DataFrame, k: int = S.RESERVOIR_SIZE, tie: tuple[str, ...] = ()) -> DataFrame:
    """Sample of everything seen so far from two keyed samples."""
    return bottom_k(previous.unionByName(batch), k, tie)
