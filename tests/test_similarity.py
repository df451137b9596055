import random
from itertools import combinations

from pyspark.sql import functions as F

from tempoflow.functions import hashing as H
from tempoflow.operators import similarity as L


def random_items(spark, n=220, seed=2):
    """Few levels, so that many items agree; a third of the items are copies of one triple."""
    rng = random.Random(seed)
    rows = [(i, 5, 5, 5) if rng.random() < 0.33 else (i, *[rng.randrange(9) for _ in range(3)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "item long, level_0 long, level_1 long, level_2 long")


def exact(rows):
    found = {}
    for a, b in combinations(rows, 2):
        shared = sum(x == y for x, y in zip(a[1:], b[1:]))
        if shared >= 2:
            found[a[0], b[0]] = found[b[0], a[0]] = shared / (6 - shared)
    return found


def buckets(spark, items, threshold, mode):
    index = L.lsh_index(items, threshold, mode).select(*L.LEVELS, "bucket").collect()
    keys = {}
    for r in index:
        keys.setdefault((r["level_0"], r["level_1"], r["level_2"]), set()).add(r["bucket"])
    return keys


def test_counts_and_groups_equal_brute_force(spark):
    rows, items = random_items(spark)
    pairs = exact(rows)
    for r in L.similar_counts(items).collect():
        mine = [s for (a, _), s in pairs.items() if a == r["item"]]
        assert (r["identical"], r["half_shared"]) == (mine.count(1.0), mine.count(0.5))
    half = L.jaccard_groups(items).agg(F.sum("half_pairs")).first()[0]
    assert half == sum(1 for s in pairs.values() if s == 0.5) / 2


def keys_of(frame):
    keys = {}
    for r in frame.collect():
        keys.setdefault((r["level_0"], r["level_1"], r["level_2"]), set()).add(r["key"])
    return keys


def test_keys_are_shared_exactly_by_similar_triples(spark):
    rows, items = random_items(spark)
    keys = keys_of(L.jaccard_keys(items))
    assert all(len(k) == 3 for k in keys.values())
    for a, b in combinations(keys, 2):
        assert bool(keys[a] & keys[b]) == (sum(x == y for x, y in zip(a, b)) >= 2)
    assert sum(r["items"] for r in L.jaccard_keys(items).collect()) == 3 * len(rows)


def test_verified_keys_equal_brute_force_over_the_index(spark):
    _, items = random_items(spark)
    for mode in (H.PORTABLE, H.FAST):
        for threshold in (0.5, 0.7):
            met = buckets(spark, items, threshold, mode)
            keys = keys_of(L.lsh_verified_keys(items, threshold, mode))
            assert keys.keys() == met.keys()
            for a, b in combinations(keys, 2):
                shared = sum(x == y for x, y in zip(a, b))
                assert bool(keys[a] & keys[b]) == (bool(met[a] & met[b]) and shared / (6 - shared) >= threshold)


def test_candidates_are_the_buckets_with_several_items(spark):
    _, items = random_items(spark)
    index = L.lsh_index(items).collect()
    sizes = {}
    for r in index:
        sizes[r["band"], r["bucket"]] = sizes.get((r["band"], r["bucket"]), 0) + r["items"]
    want = sorted(str((r["band"], r["bucket"], *[r[l] for l in L.LEVELS])) for r in index if sizes[r["band"], r["bucket"]] > 1)
    assert sorted(str((r["band"], r["bucket"], *[r[l] for l in L.LEVELS])) for r in L.lsh_candidates(items).collect()) == want


def test_pair_counts_of_huge_groups_keep_their_digits(spark):
    triples = spark.createDataFrame([(1, 1, 1, 10**9), (1, 1, 2, 1), (1, 1, 3, 1)], "level_0 long, level_1 long, level_2 long, items long")
    half = {r["shared_key"]: r["half_pairs"] for r in L.group_pairs(triples).collect()}
    assert half["01|1|1"] == 2 * 10**9 + 1


def test_point_query_lists_every_partner(spark):
    rows, items = random_items(spark)
    probes = items.where(F.col("item").isin(0, 1, 2))
    found = {(r["probe"], r["similar_item"]): r["jaccard"] for r in L.similar_to(probes, items).collect()}
    assert found.items() <= exact(rows).items()
    same = {(a, b) for (a, b), s in exact(rows).items() if s == 1.0 and a in (0, 1, 2)}
    assert same <= set(found)


def test_jaccard_values(spark, make_tracks):
    base = {"danceability": 0.5, "energy": 0.5, "tempo": 100.0}
    tracks = make_tracks([base, base, {**base, "energy": 0.9}, {**base, "energy": 0.1, "tempo": 60.0}])
    items = L.item_levels(tracks)
    found = {(r["probe"], r["similar_item"]): r["jaccard"] for r in L.similar_to(items, items).collect() if r["jaccard"] == 1.0}
    assert found == {(0, 1): 1.0, (1, 0): 1.0}
    counts = {r["item"]: (r["identical"], r["half_shared"]) for r in L.similar_counts(items).collect()}
    assert counts == {0: (1, 1), 1: (1, 1), 2: (0, 2), 3: (0, 0)}


def test_missing_features_count_as_zero(make_tracks):
    row = L.feature_tokens(make_tracks([{"energy": 0.25}])).first()
    assert (row["token_0"], row["token_1"], row["token_2"]) == ("0:0", "1:25", "2:0")


def test_latest_row_per_song(make_tracks):
    tracks = make_tracks([{"name": "a", "artist": "x", "popularity": p} for p in (1, 2, 3)])
    rows = L.latest_per_song(tracks).collect()
    assert [(r["song_id"], r["popularity"]) for r in rows] == [("a-x", 3)]
    assert [r["item"] for r in L.song_items(tracks).collect()] == ["a-x"]


def test_native_neighbours(spark):
    _, items = random_items(spark)
    nearest = L.native_neighbours(items, items.orderBy("item").limit(1), 3).orderBy("distance").first()
    assert nearest["distance"] == 0.0
