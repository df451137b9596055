"""Flajolet-Martin distinct counting.

One pass: every estimator is a ``max`` over the lowest set bit of its hash word, so rows are never multiplied by the
number of estimators and only one row of registers per group and task is shuffled. Registers merge by ``max``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions import hashing as H

# Fixed value: mean overshoot of the uncorrected estimator.
OVERSHOOT = 1.2594
BASE = "_base"


def _register(index: int) -> str:
    return f"register_{index}"


def _zeros(estimators: int) -> Column:
    """The registers as an array of trailing zero counts."""
    return F.transform(F.array(*[_register(i) for i in range(estimators)]), H.bit_index)


def register_aggregates(estimators: int = S.FM_ESTIMATORS, mode: str = H.FAST) -> list[Column]:
    """Register columns over the base column made by :func:`with_base`."""
    words = [H.word_sql(BASE, i, mode) for i in range(estimators)]
    return [F.expr(f"max({w} & -{w})").alias(_register(i)) for i, w in enumerate(words)]


def with_base(df: DataFrame, item: str, group: tuple[str, ...] = (), mode: str = H.FAST) -> DataFrame:
    return df.select(*group, H.base(F.col(item), mode).alias(BASE))


def registers(
    df: DataFrame,
    item: str = "name",
    group: tuple[str, ...] = (),
    estimators: int = S.FM_ESTIMATORS,
    mode: str = H.FAST,
) -> DataFrame:
    """One row of registers per group (one row in all without a group)."""
    return with_base(df, item, group, mode).groupBy(*group).agg(*register_aggregates(estimators, mode))


def merge(tables: list[DataFrame], group: tuple[str, ...] = (), estimators: int = S.FM_ESTIMATORS) -> DataFrame:
    """Registers of the union of several inputs."""
    everything = reduce(lambda a, b: a.unionByName(b), tables)
    names = [_register(i) for i in range(estimators)]
    return everything.groupBy(*group).agg(*[F.max(n).alias(n) for n in names])


def estimate(
    register_rows: DataFrame,
    group: tuple[str, ...] = (),
    estimators: int = S.FM_ESTIMATORS,
    corrected: bool = False,
) -> DataFrame:
    """Two to the mean register; null when nothing was counted."""
    mean = F.aggregate(_zeros(estimators), F.lit(0), lambda total, z: total + z) / F.lit(float(estimators))
    value = F.pow(F.lit(2.0), F.col("mean_zeros"))
    if corrected:
        value = value / F.lit(OVERSHOOT)
    return register_rows.select(*group, mean.alias("mean_zeros")).select("*", value.alias("estimate"))


def long_registers(register_rows: DataFrame, group: tuple[str, ...] = (), estimators: int = S.FM_ESTIMATORS) -> DataFrame:
    """Registers as rows (group, estimator, max_zeros)."""
    return register_rows.select(*group, F.posexplode(_zeros(estimators)).alias("estimator", "max_zeros"))


def error(df: DataFrame, item: str = "name", estimators: int = S.FM_ESTIMATORS, mode: str = H.FAST) -> DataFrame:
    """Estimate against the exact count. The exact side is reduced to distinct items before it is counted."""
    exact = df.agg(F.count_distinct(item).alias("exact_count"))
    approx = estimate(registers(df, item, (), estimators, mode), (), estimators)
    return approx.select(
        "estimate", exact.scalar().alias("exact_count")
    ).select(
        "exact_count",
        "estimate",
        (F.abs(F.col("estimate") - F.col("exact_count")) / F.col("exact_count") * 100).alias("error_percent"),
    )


def explain_items(df: DataFrame, item: str = "name", estimators: int = S.FM_ESTIMATORS, mode: str = H.FAST) -> DataFrame:
    """Hash word and trailing zeros of every distinct item under every estimator."""
    items = df.select(F.col(item).alias("item")).where(F.col("item").isNotNull()).distinct()
    words = H.word_array(F.col("item"), estimators, mode)
    return items.select("item", F.posexplode_outer(words).alias("estimator", "hash_value")).select(
        "item", "estimator", "hash_value", H.trailing_zeros(F.col("hash_value")).alias("trailing_zeros")
    )


def native_estimate(df: DataFrame, item: str = "name", group: tuple[str, ...] = ()) -> DataFrame:
    """Spark's own sketches as the production alternative."""
    return df.groupBy(*group).agg(
        F.approx_count_distinct(item).alias("approx_count"),
        F.hll_sketch_estimate(F.hll_sketch_agg(item)).alias("hll_count"),
    )
