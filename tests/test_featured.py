"""Items and features of two streams joined epoch by epoch: as one join of all, whatever the cut, and without rows of equal tracks compared at all times."""

import datetime as dt
import re

import pytest

from tempoflow.sources import readers
from tempoflow.sources.store import Store
from tempoflow.streaming import epochs, joins
from tempoflow.streaming.carried import Featured
from tempoflow.streaming.epochs import AVAILABLE_NOW, finish

ITEM, MEASURED = "track_id string, name string, timestamp timestamp", "id string, measured_at timestamp, energy double"


def at(minutes):
    return None if minutes is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


@pytest.fixture
def featured(spark, tmp_path):
    return Featured(Store(spark, str(tmp_path)), wait="10 minutes", delay="20 minutes")


def feed(featured, epoch, items, features):
    spark = featured.store.spark
    rows = [spark.createDataFrame([(k, n, at(t)) for k, n, t in items], ITEM), spark.createDataFrame([(k, at(t), e) for k, t, e in features], MEASURED)]
    for _ in range(2):  # replayed
        featured.add(Featured.sides(*rows), epoch)
    return sorted((r["name"], r["energy"]) for r in featured.rows().collect())


def test_features_join_in_time_and_late_ones_do_not(featured):
    items = [("1", "at once", 0), ("2", "soon", 1), ("3", "too late", 2), ("4", "never", 3), ("5", "before", 4), (None, "no track", 4), ("1", "no time", None)]
    assert feed(featured, 0, items, [("1", 0, 0.1), ("5", 3, 0.5), ("9", 9, 0.9), ("1", None, 0.7)]) == [("at once", 0.1)]
    passed = [("at once", 0.1), ("before", None), ("never", None), ("no track", None), ("soon", 0.2), ("too late", None)]
    assert feed(featured, 1, [("8", "later", 60)], [("2", 11, 0.2), ("3", 13, 0.3), ("9", 60, 0.9)]) == passed
    assert feed(featured, 2, [("4", "late", 12)], [("4", 12, 0.4), ("8", 65, 0.8)]) == sorted([*passed, ("later", 0.8)])
    assert [r["name"] for r in featured.store.read("items").collect()] == ["later"]


def test_an_item_that_has_met_features_never_goes_without(featured):
    assert feed(featured, 0, [("1", "a", 0), ("1", "a", 0)], [("1", 1, 0.1)]) == [("a", 0.1)] * 2
    assert feed(featured, 1, [("7", "b", 29)], [("7", 29, 0.7)]) == [("a", 0.1)] * 2 + [("b", 0.7)]  # the watermark is at minute 9
    assert feed(featured, 2, [], [("1", 10, 0.2), ("1", 8, 0.3)]) == [("a", 0.1)] * 2 + [("a", 0.2)] * 2 + [("b", 0.7)]
    assert feed(featured, 3, [("7", "c", 100)], [("6", 100, 0.6)]) == [("a", 0.1)] * 2 + [("a", 0.2)] * 2 + [("b", 0.7)]
    assert feed(featured, 4, [("6", "d", 200)], [("5", 200, 0.5)])[-2:] == [("b", 0.7), ("c", None)]


def test_nothing_passes_before_both_sides_have_come(featured):
    assert feed(featured, 0, [("1", "a", 0), ("2", "b", 500)], []) == []
    assert feed(featured, 1, [], [("1", 3, 0.1), ("2", 500, 0.2)]) == [("a", 0.1), ("b", 0.2)]


@pytest.mark.parametrize("cuts", [[0, 4000], [0, 30, 31, 700, 4000]])
def test_any_cut_in_time_gives_what_one_join_gives(spark, featured, cuts):
    items = [(str(i % 7), f"n{i}", i * 13 % 4000) for i in range(900)]
    features = [(str(i % 11), i * 37 % 4000, float(i)) for i in range(600)]
    for epoch, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        found = feed(featured, epoch, [i for i in items if low <= i[2] < high], [f for f in features if low <= f[1] < high])
    mark = min(max(i[2] for i in items), max(f[1] for f in features)) - 20
    meets = [(n, t, [e for key, m, e in features if key == k and t <= m <= t + 10]) for k, n, t in items]
    assert found == sorted([(n, e) for n, _, es in meets for e in es] + [(n, None) for n, t, es in meets if not es and t + 10 < mark])


def test_the_stream_holds_no_row_in_a_state_store(spark, tmp_path):
    """Every row of a first epoch would be held, however many there are."""
    sides = {"items": ([("1", "a", at(0)), ("2", "b", at(0)), ("9", "c", at(90))], ITEM), "features": ([("1", at(1), 0.1), ("8", at(90), 0.8)], MEASURED)}
    for name, (rows, kind) in sides.items():
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / name))
    items, features = [readers.read_stream(spark, "parquet", {}, spark.createDataFrame([], k).schema, str(tmp_path / n)) for n, (_, k) in sides.items()]
    featured = Featured(Store(spark, str(tmp_path / "result")), wait="10 minutes", delay="20 minutes")
    finish(epochs.start(Featured.sides(items, features), featured.handler(), str(tmp_path / "checkpoint"), trigger=AVAILABLE_NOW))
    assert {(r["name"], r["energy"]) for r in featured.rows().collect()} == {("a", 0.1), ("b", None)}
    assert not (tmp_path / "checkpoint" / "state").exists()
    assert [featured.store.read(n).count() for n in ("items", "features")] == [1, 1]


def test_a_hot_track_is_compared_near_in_time_only(spark):
    """Rows of one track over many days: each lies with few features under a key of the join."""
    items = spark.range(2000).selectExpr("'1' as track_id", "'n' as name", "timestamp_seconds(id * 3600) as timestamp")
    features = spark.range(2000).selectExpr("'1' as id", "timestamp_seconds(id * 3600) as measured_at", "double(id) as energy")
    found = joins.with_features(items, features, wait="30 minutes")
    assert found.where("energy is not null").count() == found.count() == 2000
    keys = re.search(r"Join \[([^]]*)\]", found._jdf.queryExecution().executedPlan().toString())
    assert "_stretch" in keys[1]
