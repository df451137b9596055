"""Joins of two streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def span(interval: str) -> Column:
    """The microseconds of an interval such as ``6 hours``."""
    start = F.timestamp_micros(F.lit(0))
    return F.unix_micros(start + F.expr(f"INTERVAL {interval}")) - F.unix_micros(start)


def with_features(items: DataFrame, features: DataFrame, wait: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Add audio features to flattened playlist items as both stream in.

    An item (``track_id``, ``timestamp``) meets features of its track (``id``, ``measured_at``) that are measured at its time or up to ``wait``
    later. It is passed on at once when they come, and with nulls once the watermark says that none can come any more. Rows that are
    more than ``delay`` behind the newest ones of their stream are late and may be dropped. So both sides are held no
    longer than the two spans, and a hot track is bounded by its rows within them.

    Rows meet by track and stretch of time: an item lies in one stretch, features go to each in which items may wait for them. So a row is
    compared with those of its track near in time, not with all. On frames that are no streams it is the same join, without watermarks.
    """
    length = F.greatest(8 * span(wait), F.lit(1))
    stretch = lambda micros: F.floor(micros / length)
    measured = F.unix_micros("measured_at")
    # twice the wait back: a day in it may have more than 24 hours
    reached = F.sequence(stretch(measured - 2 * span(wait)), stretch(measured))
    left = items.withWatermark("timestamp", delay).withColumn("_stretch", stretch(F.unix_micros("timestamp")))
    right = features.withColumnRenamed("id", "_id").withWatermark("measured_at", delay).withColumn("_reached", F.explode(reached))
    # a number that tells keys apart comes first: sorting by it seldom compares texts
    left = left.withColumn("_key", F.xxhash64("track_id", "_stretch"))
    right = right.withColumn("_other", F.xxhash64("_id", "_reached"))
    meets = (
        (F.col("_key") == F.col("_other"))
        & (F.col("track_id") == F.col("_id"))
        & (F.col("_stretch") == F.col("_reached"))
        & (F.col("measured_at") >= F.col("timestamp"))
        & (F.col("measured_at") <= F.col("timestamp") + F.expr(f"INTERVAL {wait}"))
    )
    return left.join(right, meets, "leftOuter").drop("track_id", "_id", "measured_at", "_stretch", "_reached", "_key", "_other")
