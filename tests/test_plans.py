"""Shape of the physical plans: what must not appear at scale."""

import re

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tempoflow.operators import distinct, lastn, membership, privacy, ranking, similarity, stats, unlearning
from tempoflow.plans import views
from tempoflow.session import broadcast_if_small
from tempoflow.sources import codec, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_read_only_their_columns(spark):
    text = plan(stats.artist_stats(tables.line_plays(spark, DATA)))
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_discount:double>", text)
    assert text.count("Exchange") == 1


def test_filters_reach_the_scan(spark):
    text = plan(tables.line_plays(spark, DATA).where(F.col("danceability") > 0.05).select("name"))
    assert "GreaterThan(l_discount,0.05)" in text


def test_registers_need_one_exchange_and_no_expansion(spark):
    text = plan(distinct.registers(tables.tracks(spark, DATA), group=("artist",)))
    assert text.count("Exchange") == 1 and "Generate" not in text


def test_last_rows_are_cut_before_the_shuffle(spark):
    text = plan(ranking.last_n(tables.tracks(spark, DATA), ["artist"], ["seq"], 100))
    assert text.rindex("Final") < text.rindex("Exchange") < text.rindex("Partial")
    assert text.count("WindowGroupLimit") == 4  # per share, then per key, each before and after its shuffle


def test_no_window_over_a_single_partition_of_rows(spark):
    tracks = tables.tracks(spark, DATA)
    for frame in (privacy.k_anonymity(tracks), lastn.window_ones(tracks), stats.distribution(tracks)):
        text = plan(frame)
        # The only single-partition step sums the sizes of the range partitions.
        for match in re.finditer(r"Exchange SinglePartition.*\n(.*)\n", text):
            assert "_part" in match.group(0) or "HashAggregate" in match.group(0)


def test_small_request_tables_are_broadcast_and_large_ones_are_not(spark):
    tracks = tables.tracks(spark, DATA)
    requests = views.forget_requests(spark, DATA)
    assert "BroadcastHashJoin" in plan(unlearning.drop_forgotten(tracks, requests))
    wide = spark.range(200_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    assert "ResolvedHint" not in broadcast_if_small(wide)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in broadcast_if_small(wide.limit(10))._jdf.queryExecution().analyzed().toString()


def test_top_k_is_a_bounded_heap(spark):
    assert "TakeOrderedAndProject" in plan(stats.trending(tables.tracks(spark, DATA)))


@pytest.fixture
def small_skew_limits(spark):
    """Shuffle joins only, with skew limits low enough for test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def skewed_ids(spark, rows=60_000):
    """A third of the rows carry one id."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 12).select("id", hot.cast("string").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def split_joins(df):
    return plan(df).split("Initial Plan")[0].count("skew=true")


def test_hot_track_is_split_in_the_feature_join(spark, small_skew_limits):
    tracks = skewed_ids(spark).select(F.col("key").alias("track_id"), F.col("text").alias("name"))
    features = spark.range(0, 60_000, 1, 12).select(F.col("id").cast("string"), F.col("id").alias("tempo"))
    joined = codec.with_audio_features(tracks, features)
    assert len(joined.collect()) == 60_000
    assert split_joins(joined) == 1


def test_hot_track_is_split_when_the_request_table_is_large(spark, small_skew_limits, monkeypatch):
    monkeypatch.setattr(unlearning, "broadcast_if_small", lambda df: df)
    tracks = skewed_ids(spark).select(F.col("key").alias("name"), F.substring("text", 1, 2).alias("artist"), "text")
    gone = unlearning.request(spark, "track", "5").unionByName(unlearning.request(spark, "artist", "none"))
    kept = unlearning.drop_forgotten(tracks, gone)
    assert len(kept.collect()) == 60_000 - 1
    assert split_joins(kept) >= 1


def test_hot_item_is_split_in_the_joined_probe(spark, small_skew_limits):
    items = skewed_ids(spark).select(F.col("key").alias("name"), "text")
    words = membership.build(items.where("name = '7'"), bits=1 << 20)
    found = membership.probe(items, words, bits=1 << 20, inline_bits=0)
    assert len(found.collect()) == 20_001
    assert split_joins(found) >= 1


def test_hot_triple_is_split_when_counts_are_attached(spark, small_skew_limits):
    level = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id"))
    items = spark.range(0, 60_000, 1, 12).select(F.col("id").alias("item"), *[level.alias(name) for name in similarity.LEVELS])
    counts = similarity.similar_counts(items)
    assert counts.agg(F.max("identical")).first()[0] == 20_000
    counts.collect()
    assert split_joins(counts) >= 1


def test_share_of_total_reads_the_table_once(spark):
    frame = stats.distribution(tables.tracks(spark, DATA))
    frame.collect()
    final = plan(frame).split("Initial Plan")[0]
    assert "ReusedExchange" in final
