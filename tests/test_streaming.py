"""Streams over several files, one file per micro-batch, must end where the batch operators end."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tempoflow.functions import hashing as H
from tempoflow.operators import distinct, lastn, membership, privacy, sampling, stats, unlearning
from tempoflow.plans import views
from tempoflow.sources import readers, tables
from tempoflow.streaming import epochs, jobs, stateful
from tempoflow.streaming.epochs import AVAILABLE_NOW, EpochTable, finish


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """The events cut into four files that arrive in order."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = tables.table(spark, DATA, "events")
    for part in range(4):
        chunk = events.where((F.col("event_id") >= part * 250) & (F.col("event_id") < (part + 1) * 250))
        chunk.coalesce(1).write.mode("append").parquet(folder)
    return folder, events.schema


@pytest.fixture
def stream(spark, source):
    folder, schema = source
    raw = readers.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, schema, folder)
    return tables.tracks_from_events(raw)


@pytest.fixture(scope="module")
def batch(spark):
    return tables.tracks(spark, DATA)


def rows(df):
    return sorted(map(str, df.collect()))


def kept_epochs(table, spark):
    return sorted(r["epoch"] for r in table.all(spark).select("epoch").distinct().collect())


def test_complete_mode_aggregates(spark, stream, batch, tmp_path):
    for name, build in {
        "stats": lambda df: stats.artist_stats(df).select("artist", "track_count"),
        "total": stats.running_total,
        "fm": lambda df: distinct.registers(df, mode=H.FAST),
        "bloom": lambda df: membership.build(df.where("popularity > 80")),
    }.items():
        query, table = jobs.snapshot_job(build(stream), str(tmp_path / name), AVAILABLE_NOW)
        finish(query)
        assert rows(table.latest(spark)) == rows(build(batch))
        assert kept_epochs(table, spark) == [2, 3]


def test_reservoir_over_batches(spark, stream, batch, tmp_path):
    key = sampling.hashed_key()
    query, table = jobs.reservoir_job(stream.select("seq", "name"), str(tmp_path), key=key, tie=("seq",), trigger=AVAILABLE_NOW)
    finish(query)
    expected = sampling.reservoir_sample(batch.select("seq", "name"), key=key, tie=("seq",))
    assert rows(table.latest(spark).drop(sampling.KEY)) == rows(expected)
    assert kept_epochs(table, spark) == [2, 3]


@pytest.mark.parametrize("window", [10, 100])
def test_dgim_state_over_batches(spark, stream, batch, tmp_path, window):
    query, table = jobs.dgim_job(stream, str(tmp_path), AVAILABLE_NOW, n=window)
    finish(query)
    got = stateful.dgim_estimates(table.latest(spark)).withColumnRenamed("group", "artist")
    expected = lastn.dgim_stats(batch, n=window).select("artist", "signal", "estimated_count", "current_position", "bucket_count")
    assert rows(got) == rows(expected)
    assert table.latest(spark).agg(F.max(F.size("heads"))).first()[0] <= 14


def test_random_keys_are_carried_with_the_sample(spark, stream, tmp_path):
    query, table = jobs.reservoir_job(stream.select("seq"), str(tmp_path), k=25, trigger=AVAILABLE_NOW)
    finish(query)
    keys = [r[sampling.KEY] for r in table.latest(spark).collect()]
    assert len(keys) == 25 and len(set(keys)) == 25 and all(len(k) == 32 for k in keys)


def test_replayed_epoch_changes_nothing(spark, batch, tmp_path):
    table = EpochTable(str(tmp_path), stateful.DGIM_STATE, slots=2)
    handle = stateful.dgim_handler(table)
    handle(batch.where("seq < 500"), 0)
    handle(batch.where("seq >= 500"), 1)
    once = rows(table.latest(spark))
    handle(batch.where("seq >= 500"), 1)
    assert rows(table.latest(spark)) == once


def test_restart_from_checkpoint(spark, source, batch, tmp_path):
    folder, schema = source
    inbox = str(tmp_path / "inbox")
    events = spark.read.schema(schema).parquet(folder)
    for half in ("event_id < 500", "event_id >= 500"):
        events.where(half).coalesce(1).write.mode("append").parquet(inbox)
        tracks = tables.tracks_from_events(readers.read_stream(spark, "parquet", {}, schema, inbox))
        query, table = jobs.dgim_job(tracks, str(tmp_path / "job"), AVAILABLE_NOW)
        finish(query)
    expected = lastn.dgim_stats(batch).select("artist", "signal", "estimated_count", "current_position", "bucket_count")
    assert rows(stateful.dgim_estimates(table.latest(spark)).withColumnRenamed("group", "artist")) == rows(expected)


def test_unlearning_sees_requests_made_between_batches(spark, stream, batch, tmp_path):
    log = str(tmp_path / "log")
    unlearning.append_requests(unlearning.request(spark, "feature", "tempo"), log)
    calls = []

    def current():
        calls.append(1)
        if len(calls) == 3:
            unlearning.append_requests(unlearning.request(spark, "track", "track_3"), log)
        return unlearning.read_requests(spark, log)

    query, table = jobs.unlearn_job(stream, current, str(tmp_path / "job"), since_request=False, trigger=AVAILABLE_NOW)
    finish(query)
    kept = table.all(spark)
    before = batch.where("name = 'track_3' and seq < 500").count()
    assert kept.where("name = 'track_3'").count() == before > 0
    assert kept.where("tempo is not null").count() == 0
    assert len(calls) == 4


def test_old_events_of_a_forgotten_track_do_not_pass(spark, stream, batch, tmp_path):
    """The request is known before the stream starts and is younger than all of its events."""
    requests = unlearning.request(spark, "track", "track_3")
    query, table = jobs.unlearn_job(stream, lambda: requests, str(tmp_path), trigger=AVAILABLE_NOW)
    finish(query)
    assert batch.where("name = 'track_3'").count() > 0
    assert table.all(spark).where("name = 'track_3'").count() == 0


def test_streams_read_tables_stored_as_folders(spark, source, batch, tmp_path):
    events = tables.table(spark, DATA, "events")
    folder = str(tmp_path / "data")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    for table in ("customer", "supplier", "region", "orders"):
        tables.table(spark, DATA, table).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    raw = readers.stream_table(spark, folder, "events", files_per_trigger=1)
    query, table = jobs.snapshot_job(stats.running_total(tables.tracks_from_events(raw)), str(tmp_path / "job"), AVAILABLE_NOW)
    finish(query)
    assert table.latest(spark).first()[0] == 1000
    assert kept_epochs(table, spark) == [1, 2]
    with pytest.raises(Exception, match="not exist|FileNotFound"):
        readers.stream_table(spark, str(tmp_path / "nothing"), "events")


@pytest.mark.parametrize("name", ["stream_batch_analytics", "stream_batch_artists", "stream_batch_members", "stream_batch_filters", "stream_batch_sample", "stream_unlearn", "stream_dgim"])
def test_reports_do_not_depend_on_epochs(spark, source, tmp_path, monkeypatch, name):
    from tempoflow.plans.catalog import catalog

    events = tables.table(spark, DATA, "events")
    folder = str(tmp_path / "data")
    for part in range(3):
        chunk = events.where((F.col("event_id") >= part * 334) & (F.col("event_id") < (part + 1) * 334))
        chunk.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    for table in ("customer", "supplier", "region"):
        tables.table(spark, DATA, table).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    one_file = readers.stream_table
    monkeypatch.setattr(readers, "stream_table", lambda s, d, t: one_file(s, d, t, files_per_trigger=1))
    query = catalog()[name]
    assert rows(query.run(spark, folder)) == rows(query.run(spark, DATA))


def test_epochs_free_their_checkpoints(spark, batch, tmp_path):
    handler = jobs.batch_filters(str(tmp_path / "out"), sample_key=sampling.hashed_key())
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    before = len(fs.listStatus(root))
    for epoch in range(3):
        handler(batch.where(f"seq % 3 = {epoch}"), epoch)
        assert len(fs.listStatus(root)) == before


def test_dedup_and_windows_on_streams(spark, stream, batch, tmp_path):
    query, path = jobs.append_job(jobs.dedup_stream(stream.unionByName(stream)), str(tmp_path / "dedup"), AVAILABLE_NOW)
    finish(query)
    assert spark.read.parquet(path).count() == stats.dedup_emissions(batch).count()
    windows = stats.windowed_stats(stream.withWatermark("timestamp", "1 hour")).drop("avg_popularity")
    query, table = jobs.snapshot_job(windows, str(tmp_path / "windows"), AVAILABLE_NOW)
    finish(query)
    assert rows(table.latest(spark)) == rows(stats.windowed_stats(batch).drop("avg_popularity"))
    sessions = stats.session_stats_stream(stream.withWatermark("timestamp", "40 days")).drop("avg_popularity")
    query, table = jobs.snapshot_job(sessions, str(tmp_path / "sessions"), AVAILABLE_NOW)
    finish(query)
    expected = stats.session_stats(batch).select("session_start", "artist", "track_count")
    assert rows(table.latest(spark)) == rows(expected)


def test_batch_callbacks(spark, stream, batch, tmp_path):
    out = str(tmp_path / "analytics")
    finish(epochs.start(stream, jobs.batch_analytics(out), str(tmp_path / "c1"), trigger=AVAILABLE_NOW))
    per_epoch = spark.read.parquet(f"{out}/artist_stats").groupBy("epoch").agg(F.sum("track_count").alias("n")).collect()
    assert sorted(r["n"] for r in per_epoch) == [250] * 4
    assert spark.read.parquet(f"{out}/clusters").count() == 12

    out = str(tmp_path / "filters")
    handler = jobs.batch_filters(out, uniform=privacy.hashed_uniform(7), sample_key=sampling.hashed_key())
    finish(epochs.start(stream, handler, str(tmp_path / "c2"), trigger=AVAILABLE_NOW))
    words = membership.build(batch.where("popularity > 80"))
    assert rows(EpochTable(f"{out}/bloom", words.schema, slots=2).latest(spark)) == rows(words)
    assert spark.read.parquet(f"{out}/anonymous").count() == 1000
    assert spark.read.parquet(f"{out}/sample/slot=1").where("epoch = 3").count() == 10


def test_empty_batches_are_skipped_but_state_is_carried(spark, batch, tmp_path):
    out = str(tmp_path)
    jobs.batch_analytics(f"{out}/a")(batch.limit(0), 0)
    handler = jobs.batch_filters(f"{out}/f", sample_key=sampling.hashed_key())
    handler(batch, 0)
    handler(batch.limit(0), 1)
    assert spark.read.parquet(f"{out}/f/sample/slot=1").count() == 10


def test_failing_batch_stops_the_query(spark, stream, tmp_path):
    def broken(batch, epoch):
        raise RuntimeError("broken")

    with pytest.raises(Exception, match="broken"):
        finish(epochs.start(stream, broken, str(tmp_path), trigger=AVAILABLE_NOW))


def test_forget_requests_view(spark):
    kinds = {r["type"] for r in views.forget_requests(spark, DATA).select("type").distinct().collect()}
    assert kinds <= {"track", "artist", "feature"} and "feature" in kinds
