"""Column expressions on track records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempoflow import schema as S

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def above(column: str, threshold: float) -> Column:
    """Strictly above; null is never above."""
    return F.coalesce(F.col(column) > F.lit(threshold), F.lit(False))


def threshold_bit(column: str, threshold: float) -> Column:
    """1 from the threshold upwards, else 0; a missing value gives 0."""
    return F.coalesce((F.col(column) >= F.lit(threshold)).cast("int"), F.lit(0))


def signal_bits() -> dict[str, Column]:
    """The three monitored signals."""
    return {
        "popularity": threshold_bit("popularity", S.POPULAR_FROM),
        "energy": threshold_bit("energy", S.ENERGY_FROM),
        "danceability": threshold_bit("danceability", S.DANCE_FROM),
    }


def zero_if_null(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def normalised_tempo(column: str = "tempo") -> Column:
    return zero_if_null(column) / F.lit(S.TEMPO_SCALE)


def feature_array() -> Column:
    return F.array(zero_if_null("danceability"), zero_if_null("energy"), normalised_tempo())


def discretise(value: Column) -> Column:
    """Hundredths, rounded half to even."""
    return F.rint(value * F.lit(100.0)).cast("bigint")


def feature_levels() -> list[Column]:
    """The three discretised features; together they are the similarity key of a track."""
    return [
        discretise(zero_if_null("danceability")).alias("level_0"),
        discretise(zero_if_null("energy")).alias("level_1"),
        discretise(normalised_tempo()).alias("level_2"),
    ]


def token(axis: int, level: Column) -> Column:
    return F.concat(F.lit(f"{axis}:"), level.cast("string"))


def composite_id(separator: str = "-", name: str = "name", artist: str = "artist") -> Column:
    return F.concat(F.col(name), F.lit(separator), F.col(artist))


def range_label(low: Column, high: Column) -> Column:
    """``min-max`` with two decimals, or N/A when the group has no value."""
    return F.when(low.isNull(), F.lit("N/A")).otherwise(F.format_string("%.2f-%.2f", low, high))


def format_time(column: Column) -> Column:
    return F.date_format(column, TIME_FORMAT)


def parse_time(column: Column) -> Column:
    return F.to_timestamp(column, TIME_FORMAT)
