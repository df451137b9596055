"""What streams carry from epoch to epoch beside aggregates: histories, releases, members that can be forgotten, rows that wait for others.

Each class keeps its tables in one store and adds an epoch in one commit; an epoch that comes again is not added again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions import hashing as H
from tempoflow.functions.scalars import above
from tempoflow.operators import accounts, membership, privacy, stats, unlearning
from tempoflow.operators.ranking import global_rank, last_n_overall
from tempoflow.session import broadcast_if_small, checkpointed, freed_checkpoints, splittable
from tempoflow.sources.store import Generations, Part, Store, Version, summed
from tempoflow.streaming import joins
from tempoflow.streaming.epochs import Handler

Requests = Callable[[], DataFrame]


class Carried:
    """One epoch after the other; :meth:`_step` returns the parts and schemas of an epoch."""

    def __init__(self, store: Store):
        self.store = store

    def _step(self, base: Version, batch: DataFrame) -> dict[str, tuple[list[Part], DataFrame]]:
        raise NotImplementedError

    def add(self, batch: DataFrame, epoch: int) -> Version:
        base = self.store.version()
        if epoch <= base.epoch:
            return base
        batch = batch.persist()
        try:
            with freed_checkpoints(self.store.spark):
                tables = self._step(base, batch)
                parts, schemas = {n: p for n, (p, _) in tables.items()}, {n: df.schema for n, (_, df) in tables.items()}
                return self.store.commit(base, parts, schemas, epoch)
        finally:
            batch.unpersist()

    def handler(self, vacuum_every: int = 64) -> Handler:
        def handle(batch: DataFrame, epoch: int) -> None:
            self.add(batch, epoch)
            if vacuum_every and epoch % vacuum_every == vacuum_every - 1:
                self.store.vacuum(keep=2)

        return handle


def _history(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name").agg(F.sum("history_entries").alias("history_entries"), F.max("last_seen").alias("last_seen"))


class Histories(Carried):
    """History per track, the newest rows and the number of processed rows of a stream under forget requests.

    The requests known when an epoch comes decide what of it is processed. An epoch writes a history row per track that it
    meets, the window of ``n`` rows, and one number.
    """

    def __init__(self, store: Store, requests: Requests, n: int = S.WINDOW_ARRIVALS, order: str = "seq"):
        super().__init__(store)
        self.requests, self.n, self.order = requests, n, order
        self.history = Generations(store, "history", _history)
        self.processed = Generations(store, "processed", lambda rows: rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))

    def _step(self, base, batch):
        kept = unlearning.unlearn(batch, checkpointed(unlearning.accepted(self.requests()))).persist()
        try:
            window = kept if "active" not in base.schemas else self.store.read("active", base).unionByName(kept)
            newest = last_n_overall(window, [self.order], self.n)
            history, count = stats.track_history(kept), kept.agg(F.count(F.lit(1)).alias("rows"))
            return {
                "history": (self.history.added(base, history), history),
                "active": ([self.store.write(newest)], kept),
                "processed": (self.processed.added(base, count), count),
            }
        finally:
            kept.unpersist()

    def active_tracks(self) -> DataFrame:
        return self.store.read("active")

    def track_history(self) -> DataFrame:
        return self.history.read()

    def status(self) -> DataFrame:
        """The one-row status of the workflow, without a look at the rows."""
        processed = self.processed.read().first()["rows"]
        return unlearning.status_of(self.requests(), F.lit(processed), self.n)


class Releases(Carried):
    """k-anonymous rows released over epochs: every class has k rows or more, no row is lost and none comes out twice.

    The rows of an epoch and those held back are sorted together and cut in runs of k. The last rows, fewer than k, wait for
    the next epoch; only they are kept with their values.
    """

    def __init__(self, store: Store, k: int = S.K_ANONYMITY, identity: str = "seq", sort_by: str = "popularity"):
        super().__init__(store)
        self.k, self.identity, self.sort_by = k, identity, sort_by
        self.released = Generations(store, "released", lambda rows: rows)

    def _step(self, base, batch):
        slim = batch.select(self.identity, *S.METRICS)
        pool = slim if "held" not in base.schemas else slim.unionByName(self.store.read("held", base))
        order = F.coalesce(F.col(self.sort_by).cast("double"), F.lit(-1.0)).alias("_order")
        ranked = checkpointed(global_rank(pool.select("*", order), ["_order", self.identity], rank="_rank"))
        full = ranked.count() // self.k * self.k
        rows, held = ranked.where(F.col("_rank") <= full), ranked.where(F.col("_rank") > full).select(*slim.columns)
        out = privacy.k_anonymity(rows.select(*slim.columns), self.k, self.identity, sort_by=self.sort_by)
        return {"released": (self.released.added(base, out), out), "held": ([self.store.write(held)], held)}

    def rows(self) -> DataFrame:
        return self.released.read()

    def held(self) -> DataFrame:
        return self.store.read("held")


class Members(Carried):
    """Bloom filter of the popular tracks of a stream that can forget: a counter per position instead of a bit.

    A counter is the number of members that hash to its position, so forgetting a member takes back what it has added, and the filter is
    as if it had never been there. Which names are members is kept as well (a name with each artist it was seen with): a counter cannot
    tell whether a name that is to go ever came in, and must not fall for one that did not.
    """

    PAIR = ["name", "artist"]

    def __init__(
        self,
        store: Store,
        requests: Requests,
        popular_above: float = S.POPULAR_ABOVE,
        bits: int = S.BLOOM_BITS,
        hashes: int = S.BLOOM_HASHES,
        mode: str = H.FAST,
    ):
        super().__init__(store)
        self.requests, self.popular_above = requests, popular_above
        self.bits, self.hashes, self.mode = bits, hashes, mode
        self.pairs = Generations(store, "pairs", summed(self.PAIR, ["n"]))
        self.counters = Generations(store, "counters", summed(["position"], ["n"]))

    def _step(self, base, batch):
        requests = checkpointed(unlearning.accepted(self.requests()))
        came = batch.where(above("popularity", self.popular_above) & F.col("name").isNotNull())
        came = unlearning.drop_forgotten(came.select(*self.PAIR).distinct(), requests)
        one = lambda rows, n: rows.select(*self.PAIR, F.lit(n).cast("bigint").alias("n"))
        same = F.col("name").eqNullSafe(F.col("_name")) & F.col("artist").eqNullSafe(F.col("_artist"))
        if "pairs" in base.schemas:
            held = checkpointed(self.pairs.read(base).select(*self.PAIR))
            known = splittable(held.toDF("_name", "_artist"), "_name")
            gone = unlearning.with_stale(held, requests).where("_stale")
            changes = checkpointed(one(came.join(known, same, "left_anti"), 1).unionByName(one(gone, -1)))
            # a name is a member as long as it is left with any artist
            touched = broadcast_if_small(checkpointed(changes.select("name").distinct()))
            before = one(held.join(touched, "name", "left_semi"), 1)
        else:
            changes = checkpointed(one(came, 1))
            before = changes.limit(0)
        counts = before.groupBy("name").agg(F.sum("n").alias("had")).join(changes.groupBy("name").agg(F.sum("n").alias("change")), "name", "full_outer")
        had, change = F.coalesce("had", F.lit(0)), F.coalesce("change", F.lit(0))
        flip = ((had + change > 0).cast("bigint") - (had > 0).cast("bigint")).alias("n")
        deltas = membership.count_positions(counts.select("name", flip).where("n <> 0"), "name", self.bits, self.hashes, self.mode)
        return {"pairs": (self.pairs.added(base, changes), changes), "counters": (self.counters.added(base, deltas), deltas)}

    def words(self) -> DataFrame:
        """The filter as it would be without the forgotten."""
        return membership.words_of(self.counters.read())


class PrivateTotals(Carried):
    """Running sums of a stream, released after every epoch, for one epsilon over ``horizon`` epochs.

    Each epoch draws the noise of one node of the tree and keeps that of the nodes it needs later, at most log2(horizon) + 1 per
    metric. Beyond the horizon the budget is spent and the stream stops.
    """

    def __init__(self, store: Store, horizon: int, epsilon: float = S.EPSILON, uniform: privacy.Uniform = privacy.fresh_uniform):
        super().__init__(store)
        self.horizon, self.epsilon, self.uniform = horizon, epsilon, uniform
        self.released = Generations(store, "released", lambda rows: rows)

    def _step(self, base, batch):
        t = 1 if "totals" not in base.schemas else self.store.read("totals", base).first()["step"] + 1
        if t > self.horizon:
            raise accounts.BudgetSpent(f"epoch {t} of {self.horizon}")
        sums = accounts.step_sums(batch, F.lit(t))
        spark = self.store.spark
        zero = spark.createDataFrame([(t, m, 0.0) for m in accounts.sensitivities()], "step long, metric string, total double")
        all_sums = sums.select("step", "metric", "total").unionByName(zero)
        if t > 1:
            all_sums = all_sums.unionByName(self.store.read("totals", base).withColumn("step", F.lit(t).cast("bigint")))
        totals = checkpointed(all_sums.groupBy("step", "metric").agg(F.sum("total").alias("total")))
        needed = totals.select("metric", F.explode(accounts.nodes_of(F.col("step"), self.horizon)).alias("node")).select("metric", "node.*")
        keys = ["metric", "level", "before"]
        if t > 1:
            drawn = self.store.read("noise", base)
            new = accounts.noises(needed.join(drawn, keys, "left_anti"), self.horizon, self.epsilon, self.uniform)
            noise = drawn.join(needed, keys, "left_semi").unionByName(new)
        else:
            noise = accounts.noises(needed, self.horizon, self.epsilon, self.uniform)
        noise = checkpointed(noise.select(*keys, "noise"))
        out = totals.join(noise.groupBy("metric").agg(F.sum("noise").alias("noise")), "metric").select(
            "step", "metric", (F.col("total") + F.col("noise")).alias("private_total")
        )
        return {
            "totals": ([self.store.write(totals)], totals),
            "noise": ([self.store.write(noise)], noise),
            "released": (self.released.added(base, out), out),
        }

    def releases(self) -> DataFrame:
        return self.released.read()


class Featured(Carried):
    """Items of a stream with the audio features of another, as :func:`joins.with_features` joins them, with rows that wait kept in tables.

    An epoch joins its rows, and those that still wait, as frames: memory is that of a shuffle join, which spills, however many rows an
    epoch has. The watermark is the earlier of the newest times on both sides, less ``delay``, and there is none until both have come. What an
    epoch brings from before the last watermark is late and dropped; items no features can come for any more go with nulls.
    Only items within ``wait`` of the watermark and features after it are kept.
    """

    def __init__(self, store: Store, wait: str = "10 minutes", delay: str = "1 hour"):
        super().__init__(store)
        self.wait, self.delay = wait, delay
        self.joined = Generations(store, "joined", lambda rows: rows)

    @staticmethod
    def sides(items: DataFrame, features: DataFrame) -> DataFrame:
        """Both streams as the one that :meth:`handler` takes."""
        none = lambda df, name: F.lit(None).cast(df.schema).alias(name)
        left = items.select(F.struct("*").alias("item"), none(features, "feature"))
        return left.unionByName(features.select(none(items, "item"), F.struct("*").alias("feature")))

    def _watermark(self, newest: tuple[int | None, int | None]) -> Column | None:
        return None if None in newest else F.timestamp_micros(F.lit(min(newest))) - F.expr(f"INTERVAL {self.delay}")

    def _step(self, base, batch):
        seen = tuple(self.store.read("newest", base).first()) if "newest" in base.schemas else (None, None)
        came = batch.agg(F.max(F.unix_micros("item.timestamp")), F.max(F.unix_micros("feature.measured_at"))).first()
        newest = tuple(max((t for t in side if t is not None), default=None) for side in zip(seen, came, strict=True))
        late, mark = self._watermark(seen), self._watermark(newest)

        def side(name: str, time: str, new: dict[str, Column], held: dict[str, Column]) -> DataFrame:
            rows = batch.where(F.col(name).isNotNull()).select(f"{name}.*")
            rows = rows if late is None else rows.where(F.col(time) >= late)
            rows = rows.withColumns(new)
            return rows.unionByName(self.store.read(f"{name}s", base).withColumns(held)) if f"{name}s" in base.schemas else rows

        items = side("item", "timestamp", {"_met": F.lit(False), "_waited": F.lit(False)}, {"_waited": F.lit(True)})
        features = side("feature", "measured_at", {"_known": F.lit(False)}, {"_known": F.lit(True)})
        over = lambda time: F.lit(False) if mark is None else F.col(time) + F.expr(f"INTERVAL {self.wait}") < mark
        found = joins.with_features(items, features, self.wait, self.delay)
        # a pair comes out in the epoch of its later side, an item without any once its wait is over
        out = found.where(F.when(F.col("_known").isNull(), over("timestamp") & ~F.col("_met")).otherwise(~(F.col("_waited") & F.col("_known"))))
        out = out.drop("_met", "_waited", "_known")
        # no waiting item is before these features' times
        recent = checkpointed(features.drop("_known").where("measured_at is not null").where(~over("measured_at")))
        held = self._held(checkpointed(items.drop("_waited").where("timestamp is not null").where(~over("timestamp"))), recent)
        kept = recent if mark is None else recent.where(F.col("measured_at") >= mark)
        times = self.store.spark.range(1).select(*[F.lit(t).cast("bigint").alias(n) for n, t in zip(("items", "features"), newest, strict=True)])
        return {
            "joined": (self.joined.added(base, out), out),
            "items": ([self.store.write(held)], held),
            "features": ([self.store.write(kept)], kept),
            "newest": ([self.store.write(times)], times),
        }

    def _held(self, items: DataFrame, features: DataFrame) -> DataFrame:
        """Waiting items, and whether they have met features."""
        times = features.select("id", "measured_at", F.lit(True).alias("_now")).distinct()
        keys = items.select("track_id", "timestamp").distinct()
        met = joins.with_features(keys.withColumn("_track", F.col("track_id")), times, self.wait, self.delay).where("_now")
        met = met.select(F.col("_track").alias("track_id"), "timestamp", "_now").distinct()
        joined = items.join(met, ["track_id", "timestamp"], "left").withColumn("_met", F.col("_met") | F.coalesce("_now", F.lit(False)))
        return joined.select(*items.columns)

    def rows(self) -> DataFrame:
        return self.joined.read()
