"""SQL text of the views that the oracle queries read, and the matching frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoflow.sources import tables

TRACKS = """
tracks AS (
  SELECT event_id AS seq,
         'track_' || user_id AS name,
         'artist_' || (user_id % 20) AS artist,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE least(floor(value), 100)::INTEGER END AS popularity,
         regexp_extract(props, '([0-9]+)', 1)::DOUBLE / 100 AS danceability,
         (event_id * 37 % 101)::DOUBLE / 100 AS energy,
         (60 + event_id * 13 % 141)::DOUBLE AS tempo,
         ts AS timestamp
  FROM events)"""

ORDERS = """
tracks AS (
  SELECT o_orderkey AS seq,
         'track_' || o_custkey AS name,
         o_orderpriority AS artist,
         least(floor(o_totalprice / 4500), 100)::INTEGER AS popularity,
         (o_orderkey * 29 % 101)::DOUBLE / 100 AS danceability,
         (o_orderkey * 53 % 97)::DOUBLE / 100 AS energy,
         (60 + o_orderkey * 17 % 139)::DOUBLE AS tempo,
         o_orderdate AS timestamp
  FROM orders)"""

LINES = """
tracks AS (
  SELECT 'part_' || l_partkey AS name,
         'supplier_' || l_suppkey AS artist,
         (l_quantity * 2)::INTEGER AS popularity,
         l_discount AS danceability,
         l_quantity / 50 AS energy,
         l_tax * 1000::DOUBLE + 60 AS tempo,
         l_shipdate AS timestamp
  FROM lineitem)"""

REQUESTS = """
requests AS (
  SELECT 'track' AS type, 'track_' || c_custkey AS item,
         TIMESTAMP '2024-01-10 00:00:00' + to_minutes(c_custkey % 1000) AS timestamp, c_mktsegment AS reason
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT 'artist', 'artist_' || s_suppkey,
         TIMESTAMP '2024-01-15 00:00:00' + to_minutes(s_suppkey % 1000), 'account closed'
  FROM supplier WHERE s_acctbal > 8000
  UNION ALL
  SELECT 'feature', CASE r_regionkey WHEN 0 THEN 'tempo' WHEN 3 THEN 'popularity' ELSE 'loudness' END,
         TIMESTAMP '2024-01-20 00:00:00', r_name
  FROM region),
accepted AS (
  SELECT * FROM requests
  WHERE type <> 'feature' OR item IN ('popularity', 'danceability', 'energy', 'tempo'))"""


def forget_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forget requests derived from the tables: customers in debt, rich suppliers, and one feature per region."""
    def at(day: str, minutes: Column) -> Column:
        start = F.lit(day).cast("timestamp")
        return (start + F.make_dt_interval(F.lit(0), F.lit(0), (minutes % 1000).cast("int"))).alias("timestamp")

    tracks = (
        tables.table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(
            F.lit("track").alias("type"),
            F.concat(F.lit("track_"), F.col("c_custkey").cast("string")).alias("item"),
            at("2024-01-10 00:00:00", F.col("c_custkey")),
            F.col("c_mktsegment").alias("reason"),
        )
    )
    artists = (
        tables.table(spark, sf_dir, "supplier")
        .where(F.col("s_acctbal") > 8000)
        .select(
            F.lit("artist").alias("type"),
            F.concat(F.lit("artist_"), F.col("s_suppkey").cast("string")).alias("item"),
            at("2024-01-15 00:00:00", F.col("s_suppkey")),
            F.lit("account closed").alias("reason"),
        )
    )
    region = F.col("r_regionkey")
    features = tables.table(spark, sf_dir, "region").select(
        F.lit("feature").alias("type"),
        F.when(region == 0, "tempo").when(region == 3, "popularity").otherwise("loudness").alias("item"),
        F.lit("2024-01-20 00:00:00").cast("timestamp").alias("timestamp"),
        F.col("r_name").alias("reason"),
    )
    return tracks.unionByName(artists).unionByName(features)
