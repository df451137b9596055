"""Laplace noise, k-anonymity by micro-aggregation, and feature masking."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions import hashing as H
from tempoflow.functions.scalars import range_label
from tempoflow.operators.ranking import chunk_number, global_rank
from tempoflow.operators.stats import global_stats

Uniform = Callable[[Column], Column]

# The ranges the metrics are clipped to when noise is calibrated.
BOUNDS = {"popularity": (0.0, 100.0), "danceability": (0.0, 1.0), "energy": (0.0, 1.0)}


def fresh_uniform(label: Column) -> Column:
    """A new random number in (0, 1) per released value: the only choice that protects anything."""
    return F.rand() * F.lit(1 - 2.0**-50) + F.lit(2.0**-51)


def hashed_uniform(seed: int, mode: str = H.PORTABLE) -> Uniform:
    """Reproducible numbers for tests; noise that can be recomputed is not private."""
    return lambda label: H.uniform(F.concat(F.lit(f"{seed}:"), label), mode)


def laplace(uniform: Column, scale: float | Column) -> Column:
    centred = uniform - F.lit(0.5)
    return -F.lit(scale) * F.signum(centred) * F.log(F.lit(1.0) - F.abs(centred) * 2)


def dp_stats(df: DataFrame, epsilon: float = S.EPSILON, uniform: Uniform = fresh_uniform) -> DataFrame:
    """The global averages, each with Laplace noise of scale 1/epsilon; a missing average counts as 0."""
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.coalesce(F.col(f"avg_{m}"), F.lit(0.0)).alias("average"))
            for m in S.METRICS
        ]
    )
    long = global_stats(df).select(F.inline(rows))
    return long.select(
        "metric", (F.col("average") + laplace(uniform(F.col("metric")), 1.0 / epsilon)).alias("private_average")
    )


def dp_artist_stats(
    df: DataFrame, epsilon: float = S.EPSILON, uniform: Uniform = fresh_uniform, group: str = "artist"
) -> DataFrame:
    """Per-artist averages with noise matched to the clipped range; epsilon is split over the four releases."""
    share = epsilon / (len(BOUNDS) + 1)
    clipped = {m: F.least(F.greatest(F.col(m).cast("double"), F.lit(lo)), F.lit(hi)) for m, (lo, hi) in BOUNDS.items()}
    totals = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"sum_{m}") for m, c in clipped.items()]
    )

    def noise(name: str, sensitivity: float) -> Column:
        return laplace(uniform(F.concat(F.col(group), F.lit(f":{name}"))), sensitivity / share)

    noisy = totals.select(
        group,
        F.greatest(F.col("rows") + noise("count", 1.0), F.lit(1.0)).alias("private_count"),
        *[
            (F.col(f"sum_{m}") + noise(m, max(abs(lo), abs(hi)))).alias(f"noisy_{m}")
            for m, (lo, hi) in BOUNDS.items()
        ],
    )
    return noisy.select(
        group,
        "private_count",
        *[
            F.least(F.greatest(F.col(f"noisy_{m}") / F.col("private_count"), F.lit(lo)), F.lit(hi)).alias(
                f"private_avg_{m}"
            )
            for m, (lo, hi) in BOUNDS.items()
        ],
    )


def anonymous_runs(
    df: DataFrame,
    k: int = S.K_ANONYMITY,
    identity: str = "seq",
    sort_by: str = "popularity",
    columns: tuple[str, ...] = S.METRICS,
    partitions: int | None = None,
) -> DataFrame:
    """Sort, cut in runs of k and replace each value by the range of its run; a short last run is dropped.

    This keeps the row's id and is not for release: see :func:`k_anonymity`.

    The position comes from the distributed rank; the run number is then an evenly spread shuffle key with k rows
    each, whatever the distribution of the sorted column.
    """
    number = F.coalesce(F.col(sort_by).cast("double"), F.lit(-1.0)).alias("_order")
    slim = df.select(identity, number, *[F.col(c).cast("double").alias(c) for c in columns])
    ranked = global_rank(slim, ["_order", identity], partitions, "_rank")
    run = Window.partitionBy("_run")
    low_high = [
        column
        for c in columns
        for column in (F.min(c).over(run).alias(f"_low_{c}"), F.max(c).over(run).alias(f"_high_{c}"))
    ]
    runs = ranked.select(identity, chunk_number(F.col("_rank"), k).alias("_run"), *columns)
    return (
        runs.select(identity, F.count(F.lit(1)).over(run).alias("_size"), *low_high)
        .where(F.col("_size") >= k)
        .select(identity, *[range_label(F.col(f"_low_{c}"), F.col(f"_high_{c}")).alias(c) for c in columns])
    )


def k_anonymity(df: DataFrame, k: int = S.K_ANONYMITY, identity: str = "seq", **options) -> DataFrame:
    """The releasable rows: ranges only, shared by at least k rows each, without the id that would tell them apart."""
    return anonymous_runs(df, k, identity, **options).drop(identity)


def k_anonymity_check(anonymised: DataFrame, columns: tuple[str, ...] = S.METRICS) -> DataFrame:
    """Number of classes, smallest class and rows kept."""
    classes = anonymised.groupBy(*columns).agg(F.count(F.lit(1)).alias("size"))
    return classes.agg(
        F.count(F.lit(1)).alias("classes"), F.min("size").alias("smallest_class"), F.sum("size").alias("rows_kept")
    )


def mask_features(df: DataFrame, masked: Iterable[str]) -> DataFrame:
    """Null out masked features; unknown features are refused."""
    masked = set(masked)
    unknown = masked - set(S.MASKABLE)
    if unknown:
        raise ValueError(f"features cannot be masked: {sorted(unknown)}")
    return df.select(
        *[F.lit(None).cast(field.dataType).alias(field.name) if field.name in masked else F.col(field.name) for field in df.schema]
    )
