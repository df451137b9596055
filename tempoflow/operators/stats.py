"""Grouped statistics, top-k reports and distributions. All are partial + final aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempoflow import schema as S


def artist_stats(df: DataFrame, group: str = "artist", decimals: int | None = None) -> DataFrame:
    """Averages of the metrics and the number of emissions per artist."""
    def mean(metric: str):
        value = F.avg(metric)
        return (value if decimals is None else F.round(value, decimals)).alias(f"avg_{metric}")

    return df.groupBy(group).agg(*[mean(m) for m in S.METRICS], F.count(F.lit(1)).alias("track_count"))


def by_track_count(stats: DataFrame, group: str = "artist") -> DataFrame:
    """Busiest first; equal counts in name order."""
    return stats.orderBy(F.desc("track_count"), group)


def artist_stats_top(df: DataFrame, k: int = 5, group: str = "artist") -> DataFrame:
    """The k busiest artists with averages rounded to two decimals; each task keeps k rows."""
    return by_track_count(artist_stats(df, group, decimals=2), group).limit(k)


def global_stats(df: DataFrame) -> DataFrame:
    return df.agg(*[F.avg(m).alias(f"avg_{m}") for m in S.METRICS])


def trending(df: DataFrame, k: int = 5, order: str = "seq") -> DataFrame:
    """The k most popular rows, nulls last."""
    return (
        df.select("name", "artist", "popularity", order)
        .orderBy(F.desc_nulls_last("popularity"), "name", order)
        .limit(k)
    )


def top_artists(df: DataFrame, k: int = 5, group: str = "artist") -> DataFrame:
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("track_count"))
    return by_track_count(counts, group).limit(k)


def exact_distinct(df: DataFrame, column: str = "name") -> DataFrame:
    return df.agg(F.count_distinct(column).alias("exact_count"))


def running_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_tracks"))


def feature_correlation(df: DataFrame, columns: tuple[str, ...] = S.MASKABLE) -> DataFrame:
    """Pearson correlation of every pair of features, as one row per pair, from a single aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{a}|{b}`").alias("correlation"))
            for a, b in pairs
        ]
    )
    return wide.select(F.inline(rows))


def distribution(df: DataFrame, category: str = "artist") -> DataFrame:
    """Count and share per category. The total is a scalar over the small aggregate, not a one-task window."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("track_count"))
    total = counts.agg(F.sum("track_count")).scalar()
    return counts.select(category, "track_count", (F.col("track_count") / total).alias("share"))


def track_history(df: DataFrame, track: str = "name", moment: str = "timestamp") -> DataFrame:
    """Appearances and last sighting per track."""
    return df.groupBy(track).agg(F.count(F.lit(1)).alias("history_entries"), F.max(moment).alias("last_seen"))


def dedup_emissions(df: DataFrame, keys: tuple[str, ...] = ("name", "artist", "timestamp")) -> DataFrame:
    """Drop re-sent emissions; off by default everywhere, because the counts are of emissions."""
    return df.dropDuplicates(list(keys))


def windowed_stats(df: DataFrame, length: str = "1 day", slide: str | None = None, group: str = "artist") -> DataFrame:
    """Artist statistics per tumbling or sliding time window; usable on streams too."""
    return (
        df.groupBy(F.window("timestamp", length, slide), group)
        .agg(F.avg("popularity").alias("avg_popularity"), F.count(F.lit(1)).alias("track_count"))
        .select(F.col("window.start").alias("window_start"), group, "avg_popularity", "track_count")
    )


def session_stats(df: DataFrame, gap_seconds: int = 1800, group: str = "artist") -> DataFrame:
    """Artist statistics per session: a pause longer than the gap starts a new one.

    Rows of one artist within one gap-long time slot always belong together, so they are aggregated first; the
    ordered step then sees at most one row per artist and slot, however busy the artist is.
    """
    second = F.col("timestamp").cast("double")
    slots = df.groupBy(group, F.floor(second / F.lit(gap_seconds)).alias("_slot")).agg(
        F.min("timestamp").alias("_first"),
        F.max("timestamp").alias("_last"),
        F.sum("popularity").alias("_sum"),
        F.count("popularity").alias("_known"),
        F.count(F.lit(1)).alias("_rows"),
    )
    in_time = Window.partitionBy(group).orderBy("_slot")
    pause = F.col("_first").cast("double") - F.lag("_last").over(in_time).cast("double")
    opens = F.when(pause <= F.lit(float(gap_seconds)), F.lit(0)).otherwise(F.lit(1))
    numbered = slots.withColumn("_opens", opens).withColumn("_session", F.sum("_opens").over(in_time))
    return (
        numbered.groupBy(group, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            (F.sum("_sum") / F.sum("_known")).alias("avg_popularity"),
            F.sum("_rows").alias("track_count"),
        )
        .drop("_session")
    )


def session_stats_stream(df: DataFrame, gap: str = "30 minutes", group: str = "artist") -> DataFrame:
    """The same with Spark's session window, for streams with a watermark."""
    return (
        df.groupBy(F.session_window("timestamp", gap), group)
        .agg(F.avg("popularity").alias("avg_popularity"), F.count(F.lit(1)).alias("track_count"))
        .select(F.col("session_window.start").alias("session_start"), group, "avg_popularity", "track_count")
    )
