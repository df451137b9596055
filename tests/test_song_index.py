"""The similarity index over epochs: the same relation however the rows are cut, and only new ones are compared."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tempoflow.operators import similarity
from tempoflow.operators.similarity import LEVELS
from tempoflow.sources import tables
from tempoflow.sources.store import Store
from tempoflow.streaming.similar import SongIndex, index_handler


@pytest.fixture(scope="module")
def batch(spark):
    return tables.tracks(spark, DATA).cache()


def rows(df):
    return sorted(map(str, df.collect()))


def columns(df):
    return df.select(*LEVELS, "items", "band", "bucket")


@pytest.mark.parametrize("cut", ["seq < 0", "seq < 100", "seq % 3 = 0"])
def test_candidates_do_not_depend_on_the_cut(spark, batch, tmp_path, cut):
    """The last cut brings rows out of order: an old row that comes late does not replace a newer one."""
    index = SongIndex(Store(spark, str(tmp_path)))
    handle = index_handler(index)
    for epoch, part in enumerate((batch.where(cut), batch.where(f"not ({cut})"), batch.limit(0))):
        handle(part, epoch)
        handle(part, epoch)  # replayed
    songs = similarity.song_items(batch)
    assert rows(index.songs_of()) == rows(songs)
    assert rows(columns(index.candidates())) == rows(columns(similarity.lsh_candidates(songs)))
    probes = songs.orderBy("item").limit(3)
    assert rows(index.similar_to(probes)) == rows(similarity.similar_to(probes, songs))


def test_songs_of_earlier_epochs_are_met_and_only_once(spark, make_tracks, tmp_path):
    index = SongIndex(Store(spark, str(tmp_path)))
    song = lambda seq, name, level: {"seq": seq, "name": name, "artist": "x", "danceability": level, "energy": 0.5, "tempo": 100.0}
    first = index.add(make_tracks([song(0, "a", 0.1), song(1, "b", 0.1), song(2, "c", 0.9)]), 0)
    assert index.met_since(index.store.version(0)).where("level_0 = 10").select("items").distinct().collect()[0][0] == 2
    # d is as a and b: they meet again; c has met nobody in its own buckets but those shared by chance
    second = index.add(make_tracks([song(3, "d", 0.1)]), 1)
    met = index.met_since(first, second)
    assert met.where("level_0 = 10 and items = 3 and fresh").count() == 25
    assert met.where("level_0 = 90 and fresh").count() == 0
    # b moves over to c: its old triple loses it, the two at the new one meet
    third = index.add(make_tracks([song(4, "b", 0.9)]), 2)
    met = index.met_since(second, third)
    assert met.where("level_0 = 90 and items = 2 and fresh").count() == 25
    assert met.where("level_0 = 10 and fresh").count() == 0
    assert {(r["level_0"], r["items"]) for r in index.triples.read().collect()} == {(10, 2), (90, 2)}
    # a triple that no song has any more is in no bucket, and is not signed again when it comes back
    index.add(make_tracks([song(5, "b", 0.3)]), 3)
    index.add(make_tracks([song(6, "b", 0.1), song(6, "c", 0.1)]), 4)
    assert index.buckets().select("level_0").distinct().count() == 1
    assert index.index.read().count() == index.store.read("index").count() == 75
    assert index.similar_to(index.songs_of().where("item = 'a-x'")).count() == 3


def test_an_epoch_writes_only_what_it_changes(spark, batch, make_tracks, tmp_path):
    index = SongIndex(Store(spark, str(tmp_path)))
    index.add(batch, 0)
    before = index.store.version()
    index.add(make_tracks([{"seq": 5000, "name": "new", "artist": "x", "danceability": 0.11, "energy": 0.987, "tempo": 77.7}, {"seq": 5001}]), 1)
    after = index.store.version()
    for table in ("songs", "triples", "index", "totals"):
        assert after.tables[table][:-1] == before.tables[table]
        assert after.tables[table][-1].rows == (1 if table in ("songs", "triples") else 25)
    index.add(batch.where("seq < 50"), 2)  # nothing newer
    assert index.store.version() == after
