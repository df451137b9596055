"""Forget requests, their effect on data, the audit log and the verification of the result.

The request table (type, item, timestamp, reason) is append-only and doubles as the audit log.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.operators.privacy import mask_features
from tempoflow.operators.ranking import last_n_overall
from tempoflow.operators.stats import track_history
from tempoflow.session import broadcast_if_small, checkpointed, splittable
from tempoflow.sources.store import FILE, Store, Version

# Request types.
TYPES = ("track", "artist", "feature")


def request(spark: SparkSession, kind: str, item: str, reason: str | None = None, at: datetime | None = None) -> DataFrame:
    """One validated request row; an unknown type or feature is an error and leaves no audit entry."""
    if kind not in TYPES:
        raise ValueError(f"unknown request type: {kind}")
    if kind == "feature" and item not in S.MASKABLE:
        raise ValueError(f"unknown feature: {item}")
    return spark.createDataFrame([(kind, item, at or datetime.now(), reason)], S.FORGET_SCHEMA)


def accepted(requests: DataFrame) -> DataFrame:
    """The valid rows of a table of raw requests."""
    known = F.col("type").isin("track", "artist") | ((F.col("type") == "feature") & F.col("item").isin(*S.MASKABLE))
    return requests.where(known & F.col("item").isNotNull())


def append_requests(requests: DataFrame, path: str) -> None:
    accepted(requests).write.mode("append").parquet(path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.FORGET_SCHEMA).parquet(path)


def forgotten(requests: DataFrame, kind: str) -> DataFrame:
    """Forgotten items with the time of each request.

    Repeated requests are kept: semi and anti joins do not mind, and an ungrouped side lets adaptive execution split a
    hot track or artist.
    """
    named = accepted(requests).where(F.col("type") == kind)
    return named.select(F.col("item").alias("forgotten_item"), F.col("timestamp").alias("forgotten_at"))


def masked_features(requests: DataFrame) -> list[str]:
    """At most as many names as there are maskable features."""
    rows = accepted(requests).where(F.col("type") == "feature").select("item").distinct().collect()
    return sorted(row["item"] for row in rows)


def drop_forgotten(df: DataFrame, requests: DataFrame, since_request: bool = False) -> DataFrame:
    """Rows of neither a forgotten track nor a forgotten artist.

    With ``since_request`` only rows from the request time onwards are dropped: a history as it was lawful at each time.
    The request sides are broadcast while measured small; otherwise the anti joins shuffle and adaptive execution
    splits a hot track or artist.
    """
    for kind, column in (("track", "name"), ("artist", "artist")):
        gone = broadcast_if_small(forgotten(requests, kind))
        match: Column = F.col(column) == F.col("forgotten_item")
        if since_request:
            match = match & (F.col("timestamp") >= F.col("forgotten_at"))
        df = df.join(gone, match, "left_anti")
    return df


def mask_since(df: DataFrame, requests: DataFrame) -> DataFrame:
    """Null out each masked feature in the rows from its first request onwards."""
    first = accepted(requests).where(F.col("type") == "feature").groupBy("item").agg(F.unix_micros(F.min("timestamp")).alias("since"))
    since = {row["item"]: row["since"] for row in first.collect()}  # at most as many as there are maskable features
    later = lambda name: F.unix_micros("timestamp") >= F.lit(since[name])
    return df.select(*[F.when(later(c), F.lit(None)).otherwise(F.col(c)).alias(c) if c in since else F.col(c) for c in df.columns])


def unlearn(df: DataFrame, requests: DataFrame, since_request: bool = False) -> DataFrame:
    """Drop what is forgotten and null what is masked; all other fields pass unchanged.

    With ``since_request`` both act on rows from the request time onwards only.
    """
    kept = drop_forgotten(df, requests, since_request)
    return mask_since(kept, requests) if since_request else mask_features(kept, masked_features(requests))


def active_tracks(df: DataFrame, requests: DataFrame, order: str = "seq", n: int = S.WINDOW_ARRIVALS) -> DataFrame:
    """The newest n processed rows."""
    return last_n_overall(unlearn(df, requests), [order], n)


def audit_summary(requests: DataFrame) -> DataFrame:
    """Audit entries per type: all of them, distinct items, first and last request."""
    return (
        accepted(requests)
        .groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.count_distinct("item").alias("items"),
            F.min("timestamp").alias("first_request"),
            F.max("timestamp").alias("last_request"),
        )
    )


def status(df: DataFrame, requests: DataFrame, n: int = S.WINDOW_ARRIVALS) -> DataFrame:
    """The one-row status of the workflow."""
    return status_of(requests, drop_forgotten(df, requests).agg(F.count(F.lit(1)).alias("n")).scalar(), n)


def status_of(requests: DataFrame, processed: Column, n: int = S.WINDOW_ARRIVALS) -> DataFrame:
    """The status for a known number of processed rows."""
    valid = accepted(requests)

    def items(kind: str) -> Column:
        return F.count_distinct(F.when(F.col("type") == kind, F.col("item")))

    masked = F.array_sort(F.collect_set(F.when(F.col("type") == "feature", F.col("item"))))
    return valid.agg(
        items("track").alias("forgotten_tracks"),
        items("artist").alias("forgotten_artists"),
        F.array_join(masked, ",").alias("masked_features"),
        F.count(F.lit(1)).alias("audit_entries"),
    ).select("*", processed.alias("processed_tracks"), F.least(processed, F.lit(n)).alias("active_tracks"))


def verify_all(df: DataFrame, requests: DataFrame, n: int = S.WINDOW_ARRIVALS) -> DataFrame:
    """The four totals of the overall check."""
    count_masked = F.when(F.col("masked_features") == "", F.lit(0)).otherwise(F.size(F.split("masked_features", ",")))
    return status(df, requests, n).select(
        "active_tracks", "forgotten_tracks", "forgotten_artists", count_masked.alias("masked_features")
    )


def verify_tracks(df: DataFrame, processed: DataFrame, requests: DataFrame) -> DataFrame:
    """Per track ever seen: forgotten by name, forgotten through an artist, and what history is left of it."""
    tracks = forgotten(requests, "track").select("forgotten_item").distinct()
    artists = splittable(forgotten(requests, "artist").select("forgotten_item").distinct(), "forgotten_item")
    artists = broadcast_if_small(artists)
    # Pairs of track and artist are aggregated first, so a hot track or artist joins as one row per pair.
    pairs = df.select("name", "artist").where(F.col("name").isNotNull()).distinct()
    by_artist = (
        pairs.join(artists.withColumn("_artist_gone", F.lit(True)), F.col("artist") == F.col("forgotten_item"), "left")
        .groupBy("name")
        .agg(F.coalesce(F.bool_or("_artist_gone"), F.lit(False)).alias("artist_forgotten"))
    )
    by_track = by_artist.join(
        tracks.withColumn("_track_gone", F.lit(True)), F.col("name") == F.col("forgotten_item"), "left"
    ).select("name", F.coalesce("_track_gone", F.lit(False)).alias("track_forgotten"), "artist_forgotten")
    return by_track.join(track_history(processed), "name", "left").select(
        "name",
        "track_forgotten",
        "artist_forgotten",
        F.coalesce("history_entries", F.lit(0)).alias("history_entries"),
        "last_seen",
    )


def with_stale(df: DataFrame, requests: DataFrame) -> DataFrame:
    """Add ``_stale``: whether the track or the artist of a row is forgotten. One pass; both request tables join as flags."""
    for kind, column in (("track", "name"), ("artist", "artist")):
        items = checkpointed(splittable(forgotten(requests, kind).select("forgotten_item").distinct(), "forgotten_item"))
        gone = broadcast_if_small(items).withColumn(f"_{kind}", F.lit(True))
        df = df.join(gone, F.col(column) == F.col("forgotten_item"), "left").drop("forgotten_item")
    stale = F.coalesce("_track", F.lit(False)) | F.coalesce("_artist", F.lit(False))
    return df.withColumn("_stale", stale).drop("_track", "_artist")


def residue(stored: DataFrame, purged: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows of forgotten items in stored data and in what a purge has left of it; the second number must be 0.

    Both are counted on the rows themselves, so an incomplete purge shows.
    """
    both = stored.select("name", "artist", F.lit(False).alias("_after")).union(purged.select("name", "artist", F.lit(True)))
    flagged = with_stale(both, requests)
    return flagged.agg(
        F.count_if(~F.col("_after")).alias("stored_rows"),
        F.count_if(F.col("_stale") & ~F.col("_after")).alias("residue_before"),
        F.count_if(F.col("_stale") & F.col("_after")).alias("residue_after"),
    )


def purge(store: Store, table: str, requests: DataFrame) -> Version:
    """Remove the rows of everything forgotten from a stored table, whatever their time.

    Only the files that hold such rows are rewritten, and readers see the old version until the new one is complete. A failed
    purge changes nothing and a second one rewrites nothing. The old files are deleted by :meth:`Store.vacuum`. Tables
    written in the order of artist and name keep what is forgotten in few files.
    """
    known = checkpointed(accepted(requests))  # requests that come in meanwhile wait for the next purge as a whole
    return store.rewrite(
        table, lambda rows: with_stale(rows.select("name", "artist", FILE), known).where("_stale"), lambda rows: drop_forgotten(rows, known)
    )
