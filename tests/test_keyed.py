"""State per key in the state store, and update mode with upserts."""

import time

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tempoflow.operators import lastn, stats
from tempoflow.sources import readers, tables
from tempoflow.streaming import jobs, keyed, stateful
from tempoflow.streaming.epochs import AVAILABLE_NOW, finish

COLUMNS = ("artist", "signal", "estimated_count", "current_position", "bucket_count")


@pytest.fixture(scope="module")
def events(spark):
    return tables.table(spark, DATA, "events").cache()


@pytest.fixture
def inbox(tmp_path):
    return str(tmp_path / "inbox")


def rows(df):
    return sorted(map(str, df.collect()))


def arrive(events, inbox, condition):
    events.where(condition).coalesce(1).write.mode("append").parquet(inbox)


def stream(spark, events, inbox):
    return tables.tracks_from_events(readers.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, events.schema, inbox))


def estimates(table):
    return rows(stateful.dgim_estimates(keyed.live(table)).withColumnRenamed("group", "artist").select(*COLUMNS))


@pytest.mark.parametrize("window", [10, 100])
def test_buckets_over_epochs_and_restarts(spark, events, inbox, tmp_path, window):
    """Three files, then a restart with one more: as if all had come at once."""
    for part in range(3):
        arrive(events, inbox, f"event_id >= {200 * part} and event_id < {200 * part + 200}")
    for _ in range(2):
        query, table = jobs.dgim_state_job(stream(spark, events, inbox), str(tmp_path / "job"), AVAILABLE_NOW, n=window)
        finish(query)
        arrive(events, inbox, "event_id >= 600")
    expected = lastn.dgim_stats(tables.tracks_from_events(events), n=window).select(*COLUMNS)
    assert estimates(table) == rows(expected)
    state = spark.read.format("statestore").load(str(tmp_path / "job" / "checkpoint"))
    assert state.count() == 15


def test_a_hot_key_sends_one_row_per_task(spark, events):
    batch = tables.tracks_from_events(events).withColumn("artist", F.lit("hot")).repartition(4)
    partial = keyed.partials(batch, "artist", "seq", 10, {"energy": F.col("energy") >= 0.5})
    found = partial.collect()
    assert len(found) == 4 and sum(r["arrivals"] for r in found) == 1000 and all(len(r["orders"]) == 10 for r in found)
    assert sum(r["ones"][0] for r in found) == batch.where("energy >= 0.5").count()


def until(condition, seconds=90):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "took too long"
        time.sleep(0.3)


def test_the_state_of_a_silent_key_goes(spark, events, inbox, tmp_path):
    """Processing time runs on without data, so this query is stopped from outside."""
    path = str(tmp_path / "job")
    arrive(events, inbox, "event_id < 500")
    query, table = jobs.dgim_state_job(stream(spark, events, inbox), path, {"processingTime": "500 milliseconds"}, silence=2.0)
    gone = lambda: {r["group"] for r in table.read().where("expired").select("group").distinct().collect()}
    try:
        until(lambda: table.store.versions() and len(gone()) == 15)
        assert keyed.live(table).count() == 0
        versions = len(table.store.versions())
        arrive(events, inbox, "event_id >= 500 and user_id % 20 = 4")
        until(lambda: gone() and len(table.store.versions()) >= versions + 2)
    finally:
        query.stop()
    assert spark.read.format("statestore").load(f"{path}/checkpoint").count() == 0
    # it came back with a new state: its count is that of the second file alone
    again = table.read().where("group = 'artist_4'").first()["arrivals"]
    assert again == events.where("event_id >= 500 and user_id % 20 = 4").count()


def test_update_mode_writes_only_the_groups_that_an_epoch_meets(spark, events, inbox, tmp_path):
    arrive(events, inbox, "event_id < 500")
    for condition in ("event_id >= 500 and user_id % 20 = 8", "event_id >= 500 and user_id % 20 in (1, 2)"):
        path = str(tmp_path / "job")
        finish(jobs.update_job(stats.artist_stats(stream(spark, events, inbox)), ["artist"], path, AVAILABLE_NOW)[0])
        arrive(events, inbox, condition)
    query, table = jobs.update_job(stats.artist_stats(stream(spark, events, inbox)), ["artist"], path, AVAILABLE_NOW)
    finish(query)
    version = table.store.version()
    # the 15 groups of the first epoch, the 1 of the second merged with the 2 of the third
    assert [p.rows for p in table.parts(version)] == [15, 3] and version.epoch == 2
    expected = stats.artist_stats(tables.tracks_from_events(events.where("event_id < 500 or user_id % 20 in (1, 2, 8)"))).select("artist", "track_count")
    assert rows(table.read().select("artist", "track_count")) == rows(expected)


def test_a_replayed_epoch_is_skipped(spark, tmp_path):
    table = keyed.upserts(jobs.Store(spark, str(tmp_path)), "rows", ["id"])
    handle = keyed.upsert_handler(table, vacuum_every=2)
    handle(spark.range(4), 0)
    handle(spark.range(2, 9), 1)
    version = table.store.version()
    handle(spark.range(100), 1)
    assert table.store.version() == version and table.read().count() == 9
