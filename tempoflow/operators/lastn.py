"""Counts of ones among the last N arrivals: exact, and the exponential-bucket (DGIM) approximation.

With buckets merged as published (at most two per size, the two oldest of three merge, expiry judged at query time)
the bucket layout is a function of the number of ones so far, n. A one with age q among the ones lies at level
floor(log2 q), or one level lower while ``q <= 2^J - 1 + (n + 1) mod 2^J``. So the estimate for any window needs only n
and the number c of ones in the window: all buckets up to the one that holds age c are live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions.scalars import signal_bits
from tempoflow.operators.ranking import last_n, last_n_overall, trailing_sums


def _power(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level.cast("int"))


def bucket_level(age: Column, ones: Column) -> Column:
    """Level of the bucket that holds the one of this age; bucket size is 2^level."""
    top = F.length(F.bin(age)) - F.lit(1)
    lower_end = _power(top) - 1 + (ones + 1) % _power(top)
    return F.when((top > 0) & (age <= lower_end), top - 1).otherwise(top)


def bucket_size(age: Column, ones: Column) -> Column:
    return _power(bucket_level(age, ones))


def ones_below(level: Column, ones: Column) -> Column:
    """Ones held by all buckets of lower levels."""
    return F.when(level == 0, F.lit(0).cast("bigint")).otherwise(_power(level) - 1 + (ones + 1) % _power(level))


def bucket_slot(age: Column, ones: Column) -> Column:
    """Number of the bucket inside its level, newest first."""
    level = bucket_level(age, ones)
    return F.floor((age - 1 - ones_below(level, ones)) / _power(level)).cast("bigint")


def is_bucket_head(age: Column, ones: Column) -> Column:
    """Whether this one is the newest of its bucket."""
    level = bucket_level(age, ones)
    return (age - 1 - ones_below(level, ones)) % _power(level) == 0


def estimate_from(ones: Column, in_window: Column) -> Column:
    """Sum of the live buckets, the oldest one counted by half."""
    level = bucket_level(in_window, ones)
    held = ones_below(level, ones) + (bucket_slot(in_window, ones) + 1) * _power(level)
    return F.when(in_window == 0, F.lit(0.0)).otherwise(held - _power(level) / F.lit(2.0))


def live_buckets(ones: Column, in_window: Column) -> Column:
    """Number of live buckets: level j holds one bucket, or two if bit j of n + 1 is set."""
    level = bucket_level(in_window, ones)
    doubled = F.bit_count((ones + 1).bitwiseAND(_power(level) - 1)).cast("bigint")
    return F.when(in_window == 0, F.lit(0).cast("bigint")).otherwise(
        level.cast("bigint") + doubled + bucket_slot(in_window, ones) + 1
    )


def window_ones(
    df: DataFrame,
    key: str = "artist",
    order: str = "seq",
    n: int = S.WINDOW_ARRIVALS,
    bits: dict[str, Column] | None = None,
    **layout,
) -> DataFrame:
    """Exact ones in the last n arrivals of the key, after every arrival."""
    return trailing_sums(df, [key], [order], bits or signal_bits(), n, **layout)


def dgim_timeline(
    df: DataFrame,
    key: str = "artist",
    order: str = "seq",
    n: int = S.WINDOW_ARRIVALS,
    bits: dict[str, Column] | None = None,
    **layout,
) -> DataFrame:
    """Estimate and exact count per signal after every arrival."""
    bits = bits or signal_bits()
    sums = window_ones(df, key, order, n, bits, **layout)
    return sums.select(
        key,
        order,
        "arrival",
        *[
            column
            for b in bits
            for column in (
                estimate_from(F.col(f"total_{b}"), F.col(f"recent_{b}")).alias(f"estimated_{b}"),
                F.col(f"recent_{b}").alias(f"actual_{b}"),
            )
        ],
    )


def _long_stats(wide: DataFrame, keys: list[str], bits: dict[str, Column], n: int) -> DataFrame:
    """One row per key and signal."""
    rows = F.array(
        *[
            F.struct(F.lit(b).alias("signal"), F.col(f"total_{b}").alias("ones"), F.col(f"recent_{b}").alias("actual"))
            for b in bits
        ]
    )
    ones, actual = F.col("ones"), F.col("actual")
    return wide.select(*keys, "arrivals", F.inline(rows)).select(
        *keys,
        "signal",
        estimate_from(ones, actual).alias("estimated_count"),
        actual.alias("actual_count"),
        F.lit(n).alias("window_size"),
        F.col("arrivals").alias("current_position"),
        live_buckets(ones, actual).alias("bucket_count"),
    )


def dgim_stats(
    df: DataFrame,
    key: str = "artist",
    order: str = "seq",
    n: int = S.WINDOW_ARRIVALS,
    bits: dict[str, Column] | None = None,
) -> DataFrame:
    """State of the counters of every key at the end of the input.

    Totals are map-side combined; the window needs only the newest n rows per key, cut before the shuffle.
    """
    bits = bits or signal_bits()
    slim = df.dropna(subset=[key]).select(key, order, *[c.cast("bigint").alias(f"_bit_{b}") for b, c in bits.items()])
    totals = slim.groupBy(key).agg(
        F.count(F.lit(1)).alias("arrivals"), *[F.sum(f"_bit_{b}").alias(f"total_{b}") for b in bits]
    )
    recent = last_n(slim, [key], [order], n).groupBy(key).agg(*[F.sum(f"_bit_{b}").alias(f"recent_{b}") for b in bits])
    return _long_stats(totals.join(recent, key), [key], bits, n)


def dgim_overall(
    df: DataFrame, order: str = "seq", n: int = S.WINDOW_ARRIVALS, bits: dict[str, Column] | None = None
) -> DataFrame:
    """One counter per signal over the whole stream."""
    bits = bits or signal_bits()
    slim = df.select(order, *[c.cast("bigint").alias(f"_bit_{b}") for b, c in bits.items()])
    recent = last_n_overall(slim, [order], n).agg(*[F.sum(f"_bit_{b}").alias(f"recent_{b}") for b in bits])
    totals = slim.agg(F.count(F.lit(1)).alias("arrivals"), *[F.sum(f"_bit_{b}").alias(f"total_{b}") for b in bits])
    state = F.col("_state")
    both = totals.withColumn("_state", recent.select(F.struct(*recent.columns)).scalar()).select(
        "arrivals", *[f"total_{b}" for b in bits], *[state[f"recent_{b}"].alias(f"recent_{b}") for b in bits]
    )
    return _long_stats(both.where(F.col("arrivals") > 0), [], bits, n)


def dgim_buckets(
    df: DataFrame, bit: Column, key: str = "artist", order: str = "seq", n: int = S.WINDOW_ARRIVALS
) -> DataFrame:
    """The live buckets of one signal: size, and how many arrivals ago their newest one came."""
    slim = df.dropna(subset=[key]).select(key, order, bit.cast("bigint").alias("_bit"))
    totals = slim.groupBy(key).agg(F.sum("_bit").alias("ones"))
    newest_first = Window.partitionBy(key).orderBy("age")
    recent = (
        last_n(slim, [key], [order], n)
        .where(F.col("_bit") == 1)
        .withColumn("one_age", F.row_number().over(newest_first).cast("bigint"))
    )
    age, ones = F.col("one_age"), F.col("ones")
    return (
        recent.join(totals, key)
        .where(is_bucket_head(age, ones))
        .select(key, bucket_size(age, ones).alias("bucket_size"), F.col("age").alias("newest_age"))
    )
