import datetime as dt

import pytest
from pyspark.sql import functions as F

from tempoflow.operators import unlearning as U

NOON = dt.datetime(2024, 1, 1, 12)


def requests(spark, *rows):
    frame = None
    for kind, item in rows:
        one = U.request(spark, kind, item, "why", NOON)
        frame = one if frame is None else frame.unionByName(one)
    return frame


@pytest.fixture
def tracks(make_tracks):
    hour = lambda h: dt.datetime(2024, 1, 1, h)
    return make_tracks(
        [
            {"name": "a", "artist": "x", "popularity": 1, "timestamp": hour(9)},
            {"name": "a", "artist": "x", "popularity": 2, "timestamp": hour(13)},
            {"name": "b", "artist": "y", "popularity": 3, "timestamp": hour(13)},
            {"name": "c", "artist": "z", "popularity": 4, "timestamp": hour(14)},
            {"name": None, "artist": None, "popularity": 5, "timestamp": hour(14)},
        ]
    )


def test_unknown_requests_are_refused(spark):
    with pytest.raises(ValueError):
        U.request(spark, "genre", "rock")
    with pytest.raises(ValueError):
        U.request(spark, "feature", "loudness")


def test_forgotten_rows_go_and_nulls_stay(spark, tracks):
    log = requests(spark, ("track", "a"), ("artist", "x"), ("artist", "y"), ("feature", "popularity"))
    rows = U.unlearn(tracks, log).orderBy("seq").collect()
    assert [(r["seq"], r["popularity"]) for r in rows] == [(3, None), (4, None)]


def test_request_time_is_respected_and_purge_leaves_nothing(spark, tracks):
    log = requests(spark, ("track", "a"))
    streamed = U.drop_forgotten(tracks, log, since_request=True)
    assert sorted(r["seq"] for r in streamed.collect()) == [0, 2, 3, 4]
    row = U.residue(streamed, U.drop_forgotten(streamed, log), log).first()
    assert (row["stored_rows"], row["residue_before"], row["residue_after"]) == (4, 1, 0)
    broken = streamed.where("seq > 0")  # a purge that overlooks nothing here, and one that does
    assert U.residue(streamed, broken, log).first()["residue_after"] == 0
    assert U.residue(streamed, streamed, log).first()["residue_after"] == 1


def test_masks_begin_with_their_request(spark, tracks):
    log = requests(spark, ("feature", "popularity"))
    rows = U.unlearn(tracks, log, since_request=True).orderBy("seq").collect()
    assert [r["popularity"] for r in rows] == [1, None, None, None, None]


def test_large_request_tables_take_the_shuffle_path(spark, tracks, monkeypatch):
    log = requests(spark, ("track", "a"), ("artist", "y"))
    monkeypatch.setattr(U, "broadcast_if_small", lambda df: df)
    assert sorted(r["seq"] for r in U.drop_forgotten(tracks, log).collect()) == [3, 4]


def test_status_and_verification(spark, tracks):
    log = requests(spark, ("track", "a"), ("track", "a"), ("artist", "y"), ("feature", "tempo"))
    row = U.status(tracks, log, n=1).first()
    assert row.asDict() == {
        "forgotten_tracks": 1, "forgotten_artists": 1, "masked_features": "tempo", "audit_entries": 4,
        "processed_tracks": 2, "active_tracks": 1,
    }
    assert U.verify_all(tracks, log).first()["masked_features"] == 1
    checks = {r["name"]: r for r in U.verify_tracks(tracks, U.drop_forgotten(tracks, log), log).collect()}
    assert (checks["a"]["track_forgotten"], checks["a"]["history_entries"], checks["a"]["last_seen"]) == (True, 0, None)
    assert (checks["b"]["track_forgotten"], checks["b"]["artist_forgotten"]) == (False, True)
    assert (checks["c"]["track_forgotten"], checks["c"]["history_entries"]) == (False, 1)


def test_log_is_append_only_and_filters_unknown(spark, tmp_path):
    path = str(tmp_path / "log")
    U.append_requests(requests(spark, ("track", "a")), path)
    raw = requests(spark, ("track", "b")).unionByName(
        requests(spark, ("track", "q")).withColumn("type", F.lit("genre"))
    )
    U.append_requests(raw, path)
    assert sorted(r["item"] for r in U.read_requests(spark, path).collect()) == ["a", "b"]
    assert U.audit_summary(U.read_requests(spark, path)).first()["entries"] == 2
