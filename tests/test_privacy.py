import math
import statistics

import pytest
from pyspark.sql import functions as F

from tempoflow.operators import clustering, privacy, stats


def test_k_anonymity_nulls_first_and_short_run_dropped(make_tracks):
    tracks = make_tracks(
        [{"popularity": p, "danceability": d, "energy": 0.5} for p, d in ((30, 0.1), (10, 0.2), (None, 0.3), (20, None), (40, 0.5))]
    )
    rows = {r["seq"]: r for r in privacy.anonymous_runs(tracks, 2).collect()}
    assert privacy.k_anonymity(tracks, 2).columns == ["popularity", "danceability", "energy"]
    assert set(rows) == {2, 1, 3, 0}
    assert rows[2]["popularity"] == rows[1]["popularity"] == "10.00-10.00"
    assert rows[3]["danceability"] == "0.10-0.10"


def test_all_null_run(make_tracks):
    rows = privacy.k_anonymity(make_tracks([{"energy": 0.1}, {"energy": 0.2}]), 2).collect()
    assert [(r["popularity"], r["energy"]) for r in rows] == [("N/A", "0.10-0.20")] * 2


def test_every_class_has_k_members_even_with_one_hot_value(make_tracks):
    tracks = make_tracks([{"popularity": 50 if i % 3 else i, "danceability": i / 700, "energy": 0.1} for i in range(700)])
    for k in (2, 7):
        check = privacy.k_anonymity_check(privacy.k_anonymity(tracks, k, partitions=6)).first()
        assert check["smallest_class"] >= k and check["rows_kept"] == 700 // k * k


def test_laplace_moments(spark):
    noise = spark.range(20000).select(privacy.laplace(privacy.fresh_uniform(F.lit("x")), 2.0).alias("x"))
    values = [r["x"] for r in noise.collect()]
    assert all(v is not None and math.isfinite(v) for v in values)
    assert abs(statistics.mean(values)) < 0.15
    assert abs(statistics.mean(abs(v) for v in values) - 2.0) < 0.15


def test_noise_differs_between_releases_unless_seeded(make_tracks):
    tracks = make_tracks([{"artist": "a", "popularity": 5, "danceability": 0.5, "energy": 0.5}])
    assert privacy.dp_stats(tracks).collect() != privacy.dp_stats(tracks).collect()
    seeded = lambda: privacy.dp_stats(tracks, uniform=privacy.hashed_uniform(1)).collect()
    assert seeded() == seeded()


def test_masking_is_checked(make_tracks):
    tracks = make_tracks([{"name": "a", "tempo": 90.0, "energy": 0.5}])
    row = privacy.mask_features(tracks, ["tempo"]).first()
    assert (row["tempo"], row["energy"]) == (None, 0.5)
    with pytest.raises(ValueError):
        privacy.mask_features(tracks, ["name"])


def test_kmeans_separates_and_numbers_clusters_by_centre(make_tracks):
    rows = [{"name": f"s{i}", "popularity": i, "danceability": 0.1, "energy": 0.1, "tempo": 60.0 + 60 * (i % 3) + i / 100} for i in range(30)]
    rows.append({"name": "no tempo", "danceability": 0.1, "energy": 0.1})
    clustered = clustering.kmeans_clusters(make_tracks(rows))
    assert clustered.count() == 30
    for scale in (False, True):
        found = clustering.kmeans_clusters(make_tracks(rows[:30]), scale=scale)
        groups = found.groupBy("cluster").agg(F.min("tempo"), F.max("tempo")).collect()
        assert len(groups) == 3 and all(high - low < 1 for _, low, high in groups)
    profile = clustering.cluster_profile(clustered).collect()
    assert [p["songs_in_cluster"] for p in profile] == [10, 10, 10]
    members = clustering.cluster_members(clustered).collect()
    assert len({(m["cluster"], m["name"]) for m in members}) == len(members) == 30 and all(m["songs"] == 1 for m in members)


def test_stats_skip_nulls_and_break_ties(make_tracks):
    tracks = make_tracks([{"name": "x", "artist": a, "popularity": p} for a, p in (("b", 10), ("b", None), ("a", 5), ("a", 6))])
    rows = stats.by_track_count(stats.artist_stats(tracks)).collect()
    assert [(r["artist"], r["avg_popularity"], r["track_count"]) for r in rows] == [("a", 5.5, 2), ("b", 10.0, 2)]
    assert [r["popularity"] for r in stats.trending(tracks).collect()] == [10, 6, 5, None]
    assert stats.distribution(tracks).agg(F.sum("share")).first()[0] == 1.0
