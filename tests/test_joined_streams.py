"""Two outputs of one stream that commit together, and two streams joined in time."""

import datetime as dt

import pytest

from tempoflow import schema as S
from tempoflow.sources import codec, readers
from tempoflow.sources.store import Store
from tempoflow.streaming import jobs, joins
from tempoflow.streaming.epochs import AVAILABLE_NOW, finish

GOOD = '{"name": "a", "artist": "x", "popularity": 5}'
MESSAGES = [(0, GOOD), (1, None), (2, "  "), (3, GOOD[:-1]), (4, '{"name": "b", "popularity": "many"}'), (5, "[1]"), (6, "{}"), (7, GOOD)]
REASONS = {1: "missing", 2: "empty", 3: "malformed", 4: "wrong type", 5: "wrong type"}


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(MESSAGES, "offset long, value string")


def test_reasons(messages):
    judged = {r["offset"]: r for r in codec.judged(messages, keep=("offset",)).collect()}
    assert {k: r["reason"] for k, r in judged.items() if r["reason"]} == REASONS
    assert judged[0]["data"]["name"] == "a" and judged[4]["value"] == MESSAGES[4][1]
    assert set(judged[0]["data"].asDict()) == set(S.track_schema().fieldNames())


def test_records_and_dead_letters_come_together(spark, messages, tmp_path):
    store = Store(spark, str(tmp_path))
    outputs, handle = jobs.Decoded(store), jobs.decode_handler(store)
    handle(messages.where("offset < 4"), 0)
    handle(messages.where("offset >= 4"), 1)
    handle(messages.where("offset >= 4"), 1)  # replayed
    assert sorted(r["offset"] for r in outputs.records().collect()) == [0, 6, 7]
    assert {r["offset"]: r["reason"] for r in outputs.rejects().collect()} == REASONS
    assert {r["offset"]: r["value"] for r in outputs.rejects().collect()} == {k: v for k, v in MESSAGES if k in REASONS}


def test_an_epoch_that_fails_between_its_outputs_adds_to_none(spark, messages, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    handle = jobs.decode_handler(store)
    handle(messages.where("offset < 4"), 0)
    write, calls = store.write, []

    def second_fails(rows):
        calls.append(rows)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(rows)

    monkeypatch.setattr(store, "write", second_fails)
    with pytest.raises(RuntimeError, match="lost"):
        handle(messages.where("offset >= 4"), 1)
    monkeypatch.undo()
    assert (jobs.Decoded(store).records().count(), jobs.Decoded(store).rejects().count()) == (1, 3)
    handle(messages.where("offset >= 4"), 1)
    assert (jobs.Decoded(store).records().count(), jobs.Decoded(store).rejects().count()) == (3, 5)


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


ITEM, MEASURED = "track_id string, name string, timestamp timestamp", "id string, measured_at timestamp, energy double"


def test_features_join_in_time_and_late_ones_do_not(spark, tmp_path):
    """Epochs: items and some features; then the rest, one in time and one after the watermark has passed its item."""
    sides = {"items": ITEM, "features": MEASURED}

    def put(side, *rows):
        spark.createDataFrame(rows, sides[side]).coalesce(1).write.mode("append").parquet(str(tmp_path / side))

    def run():
        streams = {s: readers.read_stream(spark, "parquet", {}, spark.createDataFrame([], k).schema, str(tmp_path / s)) for s, k in sides.items()}
        joined = joins.with_features(streams["items"], streams["features"], wait="10 minutes", delay="20 minutes")
        query, path = jobs.append_job(joined, str(tmp_path / "job"), AVAILABLE_NOW)
        finish(query)
        return {(r["name"], r["energy"]) for r in spark.read.schema(joined.schema).parquet(path).collect()}

    put("items", ("1", "at once", at(0)), ("2", "soon", at(1)), ("3", "too late", at(2)), ("4", "never", at(3)), ("5", "before", at(4)))
    put("features", ("1", at(0), 0.1), ("5", at(3), 0.5), ("9", at(9), 0.9))
    assert run() == {("at once", 0.1)}
    put("items", ("8", "later", at(60)))
    put("features", ("2", at(11), 0.2), ("3", at(13), 0.3), ("9", at(60), 0.9))
    # the watermark is now at minute 40: whoever has waited for more than 10 minutes goes with nulls
    passed = {("at once", 0.1), ("soon", 0.2), ("too late", None), ("never", None), ("before", None)}
    assert run() == passed
    put("features", ("4", at(12), 0.4), ("8", at(65), 0.8))
    assert run() == passed | {("later", 0.8)}


def test_an_item_waits_for_a_bounded_time(spark):
    items = spark.createDataFrame([("1", "a", at(0))], ITEM)
    features = spark.createDataFrame([("1", at(10), 0.1), ("1", at(11), 0.2)], MEASURED)
    found = joins.with_features(items, features)
    assert [(r["name"], r["energy"]) for r in found.collect()] == [("a", 0.1)]
    assert found.columns == ["name", "timestamp", "energy"]
