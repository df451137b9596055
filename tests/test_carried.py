"""What streams carry over epochs: as the batch operators whatever the cut, nothing lost and nothing twice."""

import math

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tempoflow.operators import accounts, membership, privacy, stats, unlearning
from tempoflow.operators.accounts import BudgetSpent, PrivacyAccount
from tempoflow.plans import views
from tempoflow.sources import tables
from tempoflow.sources.store import Conflict, Store
from tempoflow.streaming.carried import Histories, Members, PrivateTotals, Releases



@pytest.fixture(scope="module")
def batch(spark):
    return tables.tracks(spark, DATA).cache()


@pytest.fixture(scope="module")
def requests(spark):
    return views.forget_requests(spark, DATA).cache()


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def rows(df):
    return sorted(map(str, df.collect()))


def feed(carried, batch, *conditions):
    for epoch, condition in enumerate(conditions):
        carried.add(batch.where(condition), epoch)
        carried.add(batch.where(condition), epoch)  # replayed
    return carried


CUTS = [("seq >= 0",), ("seq < 30", "seq >= 30 and seq < 700", "seq < 0", "seq >= 700"), ("seq % 2 = 1", "seq % 2 = 0")]


@pytest.mark.parametrize("cut", CUTS)
def test_window_history_and_status(batch, requests, store, cut):
    carried = feed(Histories(store, lambda: requests), batch, *cut)
    assert rows(carried.active_tracks()) == rows(unlearning.active_tracks(batch, requests).select(*carried.active_tracks().columns))
    assert rows(carried.track_history()) == rows(stats.track_history(unlearning.unlearn(batch, requests)))
    assert rows(carried.status()) == rows(unlearning.status(batch, requests))


def test_an_epoch_writes_the_tracks_that_it_meets(batch, requests, store):
    carried = Histories(store, lambda: requests.limit(0))
    carried.add(batch, 0)
    before = store.version().tables["history"]
    carried.add(batch.where("name = 'track_3'"), 1)
    after = store.version().tables["history"]
    assert after[:-1] == before and after[-1].rows == 1


@pytest.mark.parametrize("k", [2, 7])
def test_releases_lose_nothing(batch, store, k):
    carried = feed(Releases(store, k), batch, "seq < 10", "seq >= 10 and seq < 13", "seq < 0", "seq >= 13 and seq < 500", "seq >= 500")
    released, held = carried.rows().count(), carried.held().count()
    assert held < k and released + held == batch.count()
    assert privacy.k_anonymity_check(carried.rows()).first()["smallest_class"] >= k
    assert "seq" not in carried.rows().columns


def test_rows_are_held_over_three_epochs(batch, store):
    carried = Releases(store, 5)
    for epoch, (seq, out, held) in enumerate([(0, 0, 1), (1, 0, 2), (2, 0, 3), (3, 0, 4), (4, 5, 0), (5, 5, 1)]):
        carried.add(batch.where(f"seq = {seq}"), epoch)
        assert (carried.rows().count(), carried.held().count()) == (out, held)
    one = feed(Releases(Store(batch.sparkSession, store.path + "/one"), 5), batch, "seq < 5")
    first = {str(r) for r in carried.rows().collect()}
    assert first == {str(r) for r in one.rows().collect()}


@pytest.mark.parametrize("cut", CUTS)
def test_members_can_be_forgotten(batch, requests, store, cut):
    """All requests come after the last epoch of rows: the filter is as if the forgotten had never come."""
    known = [requests.limit(0)]
    carried = Members(store, lambda: known[0], bits=4000)
    feed(carried, batch, *cut)
    popular = batch.where("popularity > 80")
    assert rows(carried.words()) == rows(membership.build(popular, bits=4000))
    known[0] = requests
    for epoch in (len(cut), len(cut) + 1):  # the second time there is nothing left to forget
        carried.add(batch.limit(0), epoch)
    kept = unlearning.drop_forgotten(popular, requests)
    assert kept.count() < popular.count()
    assert rows(carried.words()) == rows(membership.build(kept, bits=4000))
    assert carried.counters.read().where("n < 0").count() == 0
    again = known[0] = requests.limit(0)
    carried.add(popular, len(cut) + 2)  # and they may come back
    assert again.isEmpty() and rows(carried.words()) == rows(membership.build(popular, bits=4000))


def test_a_name_of_two_artists_goes_with_the_last(spark, make_tracks, store):
    known = [unlearning.request(spark, "artist", "nobody")]
    carried = Members(store, lambda: known[0])
    track = lambda artist: {"name": "t", "artist": artist, "popularity": 90}
    carried.add(make_tracks([track("x"), track("y"), track("y"), track(None), {"name": None, "popularity": 99}]), 0)
    full = rows(carried.words())
    known[0] = unlearning.request(spark, "artist", "x")
    carried.add(make_tracks([track("x")]), 1)
    assert rows(carried.words()) == full and carried.counters.read().agg(F.max("n")).first()[0] <= 3
    known[0] = known[0].unionByName(unlearning.request(spark, "track", "t"))
    carried.add(make_tracks([track("z")]), 2)
    assert carried.words().isEmpty()


# ---- budgets ----------------------------------------------------------------------------------------------------


def test_an_account_refuses_what_is_beyond_its_budget(store):
    account = PrivacyAccount(store, 1.0)
    assert account.spend(0.4, "first") == pytest.approx(0.6)
    assert account.spend(0.6, "second") == pytest.approx(0.0)
    with pytest.raises(BudgetSpent):
        account.spend(0.01, "third")
    with pytest.raises(BudgetSpent):
        account.spend(0.0, "nothing")
    assert [r["purpose"] for r in account.entries().orderBy("purpose").collect()] == ["first", "second"]


def test_two_spenders_cannot_share_a_rest(store, monkeypatch):
    account, other = PrivacyAccount(store, 1.0), PrivacyAccount(Store(store.spark, store.path), 1.0)
    spent = account.spent
    monkeypatch.setattr(account, "spent", lambda: (spent(), other.spend(1.0, "other"))[0])
    with pytest.raises(Conflict):
        account.spend(1.0, "mine")
    assert other.spent() == 1.0


def test_nodes_cover_each_prefix_once(spark):
    found = spark.range(1, 41).select("id", accounts.nodes_of(F.col("id"), 40).alias("nodes")).collect()
    for t, nodes in found:
        steps = [s for level, before in nodes for s in range(before + 1, before + (1 << level) + 1)]
        assert sorted(steps) == list(range(1, t + 1)) and len(nodes) <= accounts.levels(40)


def test_noise_is_drawn_per_node(spark, batch):
    """Releases differ from exact sums by the noise of their nodes, which prefixes share."""
    day = F.datediff(F.col("timestamp"), F.lit("2023-12-31")).cast("bigint")
    run = lambda **o: {(r["step"], r["metric"]): r["private_total"] for r in accounts.dp_running_stats(batch, day, 8, **o).collect()}
    exact = run(uniform=lambda label: F.lit(0.5))
    for (step, metric), total in exact.items():
        if metric == "count":
            assert total == batch.where(day.between(1, step)).count()
    noisy = run(uniform=privacy.hashed_uniform(3), epsilon=0.5)
    noise = {key: noisy[key] - exact[key] for key in exact}
    uniform = privacy.hashed_uniform(3)
    share = 0.5 / (accounts.levels(8) * 4)
    labels = spark.createDataFrame([(level, before) for level in range(4) for before in range(0, 8, 2 << level)], "level int, before long")
    drawn = {
        (r["level"], r["before"]): r["n"]
        for r in labels.select("level", "before", privacy.laplace(uniform(F.concat_ws(":", F.lit("count"), F.col("level").cast("string"), F.col("before").cast("string"))), 1 / share).alias("n")).collect()
    }
    for step, nodes in ((1, [(0, 0)]), (3, [(1, 0), (0, 2)]), (7, [(2, 0), (1, 4), (0, 6)]), (8, [(3, 0)])):
        assert noise[step, "count"] == pytest.approx(sum(drawn[n] for n in nodes))
    fresh = run()
    assert all(math.isfinite(v) for v in fresh.values()) and fresh != run()


def test_totals_of_a_stream_as_of_the_batch(spark, batch, store):
    parts = [f"seq >= {200 * k} and seq < {200 * k + 200}" for k in range(5)]
    carried = feed(PrivateTotals(store, 5, uniform=privacy.hashed_uniform(3)), batch, *parts)
    expected = accounts.dp_running_stats(batch, F.floor(F.col("seq") / 200) + 1, 5, uniform=privacy.hashed_uniform(3))
    shown = lambda df: rows(df.select("step", "metric", F.round("private_total", 6)))
    assert shown(carried.releases()) == shown(expected)
    assert store.read("noise").count() == 4 * 2  # of step 5 = 4 + 1
    with pytest.raises(BudgetSpent):
        carried.add(batch, 5)
    assert carried.releases().count() == 4 * 5
