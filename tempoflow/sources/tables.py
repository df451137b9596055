"""Track-shaped views over the parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.session import spread_if_narrow
from tempoflow.sources import codec

COLUMNS = ("seq", "name", "artist", "popularity", "danceability", "energy", "tempo", "timestamp")


# Layouts of the tables that are read, so that no scan starts with a schema inference job.
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _prefixed(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def tracks_from_events(events: DataFrame) -> DataFrame:
    """Works on a batch frame and on a stream of the same table."""
    event, user = F.col("event_id"), F.col("user_id")
    return events.select(
        event.alias("seq"),
        _prefixed("track_", user).alias("name"),
        _prefixed("artist_", user % 20).alias("artist"),
        F.when(event % 97 == 0, F.lit(None))
        .otherwise(F.least(F.floor("value"), F.lit(100)))
        .cast("int")
        .alias("popularity"),
        (F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)).alias("danceability"),
        ((event * 37 % 101) / F.lit(100.0)).alias("energy"),
        (F.lit(60) + event * 13 % 141).cast("double").alias("tempo"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks_from_events(table(spark, sf_dir, "events"))


def order_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders seen as plays: customers are tracks and the few order priorities are (hot) artists."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("seq"),
        _prefixed("track_", F.col("o_custkey")).alias("name"),
        F.col("o_orderpriority").alias("artist"),
        F.least(F.floor(F.col("o_totalprice") / F.lit(4500.0)), F.lit(100)).cast("int").alias("popularity"),
        ((key * 29 % 101) / F.lit(100.0)).alias("danceability"),
        ((key * 53 % 97) / F.lit(100.0)).alias("energy"),
        (F.lit(60) + key * 17 % 139).cast("double").alias("tempo"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def line_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines seen as plays: the largest table; it has no unique key, so there is no ``seq``."""
    return table(spark, sf_dir, "lineitem").select(
        _prefixed("part_", F.col("l_partkey")).alias("name"),
        _prefixed("supplier_", F.col("l_suppkey")).alias("artist"),
        (F.col("l_quantity") * 2).cast("int").alias("popularity"),
        F.col("l_discount").alias("danceability"),
        (F.col("l_quantity") / F.lit(50.0)).alias("energy"),
        (F.col("l_tax") * F.lit(1000.0) + F.lit(60.0)).alias("tempo"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )


def playlist_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_from_lines(spread_if_narrow(table(spark, sf_dir, "lineitem")))


def documents_from_lines(lines: DataFrame, *keep: Column) -> DataFrame:
    """One nested document per order line, as JSON text: the part's track, and an empty item if it was returned.

    Works on a batch frame and on a stream of order lines.
    """
    def item(present, key):
        return F.struct(
            F.when(
                present,
                F.struct(
                    key.cast("string").alias("id"),
                    _prefixed("part_", key).alias("name"),
                    F.col("l_quantity").cast("int").alias("popularity"),
                    F.array(
                        F.struct(_prefixed("supplier_", F.col("l_suppkey")).alias("name")),
                        F.struct(F.col("l_linestatus").alias("name")),
                    ).alias("artists"),
                ),
            ).alias("track")
        )

    kept = F.col("l_returnflag") != F.lit("R")
    items = F.array(item(kept, F.col("l_partkey")), item(F.lit(True), F.col("l_suppkey")))
    return lines.select(*keep, F.to_json(F.struct(items.alias("items"))).alias("value"))


def audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio features by track id, from the parts."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        ((F.col("p_partkey") * 7 % 101) / F.lit(100.0)).alias("danceability"),
        (F.col("p_size") / F.lit(50.0)).alias("energy"),
        (F.col("p_retailprice") / F.lit(10.0)).alias("tempo"),
    )


def measured_features(lines: DataFrame) -> DataFrame:
    """A stream of audio features: measured anew for each order line some hours after it, never for every fifth line of an order."""
    part = F.col("l_partkey")
    hours = F.when(part % 11 == 0, F.lit(10)).otherwise(part % 7).cast("int")
    return lines.where("l_linenumber <> 5").select(
        part.cast("string").alias("id"),
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(F.lit(0), hours)).alias("measured_at"),
        ((part * 7 % 101) / F.lit(100.0)).alias("danceability"),
        (F.col("l_quantity") / F.lit(50.0)).alias("energy"),
        (F.lit(60) + part % 140).cast("double").alias("tempo"),
    )


def flattened_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = codec.decode(playlist_documents(spark, sf_dir), S.PLAYLIST_SCHEMA)
    return codec.with_audio_features(codec.flatten_items(documents), audio_features(spark, sf_dir))
