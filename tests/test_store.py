"""Versions of stored tables, copy-on-write purges, generations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tempoflow.operators import unlearning as U
from tempoflow.sources import store as st
from tempoflow.sources.store import Conflict, Generations, Store

NOON = dt.datetime(2024, 1, 1, 12)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def tracks(make_tracks):
    return make_tracks([{"name": f"t{i}", "artist": f"a{i // 10}", "popularity": i, "timestamp": NOON} for i in range(60)] + [{"name": None, "artist": None}])


def files(store, table="tracks"):
    return {name for part in store.version().tables[table] for name in part.files}


def names(df):
    return sorted(r["name"] or "" for r in df.select("name").collect())


def stored(store, tracks):
    for k in range(6):
        store.append("tracks", tracks.where(f"artist = 'a{k}'").coalesce(1))
    store.append("tracks", tracks.where("artist is null").coalesce(1))
    return store


def test_a_purge_rewrites_only_files_with_forgotten_rows(spark, store, tracks):
    before = files(stored(store, tracks))
    log = U.request(spark, "track", "t13").unionByName(U.request(spark, "artist", "a4"))
    first = U.purge(store, "tracks", log)
    after = files(store)
    assert len(before) == 7 and len(before & after) == 5
    assert names(store.read("tracks")) == sorted(r for r in names(tracks) if r != "t13" and (r == "t4" or not r.startswith("t4")))
    assert U.purge(store, "tracks", log) == first and files(store) == after
    # the old version can be read until it is deleted, and only then is what was forgotten gone from the disk
    old = store.version(first.number - 1)
    assert store.read("tracks", old).count() == 61
    assert set(store.vacuum(grace=0)) == before - after
    assert store.versions() == [first.number] and store.read("tracks").count() == 50
    with pytest.raises(Exception, match="not exist|PATH_NOT_FOUND|FileNotFound"):
        store.read("tracks", old).count()


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_failed_purge_changes_nothing(spark, store, tracks, monkeypatch, step):
    stored(store, tracks)
    version, listed = store.version(), files(store)

    def broken(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, step, broken)
    with pytest.raises(RuntimeError, match="lost"):
        U.purge(store, "tracks", U.request(spark, "artist", "a1"))
    monkeypatch.undo()
    assert store.version() == version and files(store) == listed and store.read("tracks").count() == 61
    U.purge(store, "tracks", U.request(spark, "artist", "a1"))
    assert store.read("tracks").count() == 51
    store.vacuum(grace=0)  # also takes what the failed run has left
    assert store.read("tracks").count() == 51


def test_the_audit_sees_a_broken_purge(spark, store, tracks):
    stored(store, tracks)
    log = U.request(spark, "artist", "a2")
    version = store.version()
    store.rewrite("tracks", lambda rows: rows.where("artist = 'a2'"), lambda rows: rows.where("name <> 't20'"))
    row = U.residue(store.read("tracks", version), store.read("tracks"), log).first()
    assert (row["stored_rows"], row["residue_before"], row["residue_after"]) == (61, 10, 9)
    U.purge(store, "tracks", log)
    assert U.residue(store.read("tracks", version), store.read("tracks"), log).first()["residue_after"] == 0


def test_an_old_file_survives_by_default_grace(spark, store, tracks):
    stored(store, tracks)
    U.purge(store, "tracks", U.request(spark, "artist", "a1"))
    assert store.vacuum() == []


def test_two_writers_cannot_make_the_same_version(spark, store, tracks):
    base = store.append("tracks", tracks)
    part = store.write(tracks)
    store.commit(base, {"tracks": [part]})
    with pytest.raises(Conflict):
        store.commit(base, {"tracks": []})
    assert store.read("tracks").count() == 61 and len(store.versions()) == 2


def test_tables_are_committed_together_and_epochs_once(spark, store):
    one, two = spark.range(3), spark.range(5)
    store.append_all({"one": one, "two": two}, epoch=0)
    store.append_all({"one": one, "two": two}, epoch=0)
    assert (store.read("one").count(), store.read("two").count()) == (3, 5)
    version = store.append("one", one, epoch=1)
    assert (store.read("one").count(), store.read("two").count(), version.epoch) == (6, 5, 1)
    with pytest.raises(KeyError):
        store.read("three")


def test_generations_stay_few_and_combine(spark, store):
    table = Generations(store, "sums", st.summed(["k"], ["n"]))
    latest = Generations(store, "rows", st.newest(["k"]))
    for epoch in range(20):
        rows = spark.range(10).select((F.col("id") + epoch).alias("k"), F.lit(1 if epoch % 2 else -1).cast("long").alias("n"))
        table.add(rows, 2 * epoch)
        table.add(rows, 2 * epoch)  # replayed
        latest.add(spark.range(3).select((F.col("id") * (1 + epoch % 2)).alias("k"), F.lit(epoch).alias("epoch")), 2 * epoch + 1)
    assert len(table.parts(store.version())) <= 4
    expected = {}
    for epoch in range(20):
        for i in range(10):
            expected[i + epoch] = expected.get(i + epoch, 0) + (1 if epoch % 2 else -1)
    assert {r["k"]: r["n"] for r in table.read().collect()} == {k: n for k, n in expected.items() if n}
    assert {r["k"]: r["epoch"] for r in latest.read().collect()} == {0: 19, 1: 18, 2: 19, 4: 19}
