"""The similarity index carried over the epochs of a stream: only what is new meets what is there.

Four tables of one store, committed together: the newest row of each song, the songs per feature triple, the LSH buckets of each triple
ever seen, and the songs per bucket. All are kept in generations, so an epoch writes what it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.functions import hashing as H
from tempoflow.operators import similarity
from tempoflow.operators.similarity import LEVELS
from tempoflow.session import broadcast_if_small, checkpointed, freed_checkpoints, splittable
from tempoflow.sources.store import Generations, Store, Version, newest, summed
from tempoflow.streaming.epochs import Handler

BUCKET = ["band", "bucket"]


class SongIndex:
    """LSH index of the songs of a stream.

    A later row of a song (by ``seq``) replaces the earlier one: its triple loses a song and another one gains it. Triples are signed
    once, when they come up first. Equal epochs are taken once; rows without a song id are left out.
    """

    def __init__(self, store: Store, threshold: float = 0.5, mode: str = H.FAST):
        self.store, self.threshold, self.mode = store, threshold, mode
        self.songs = Generations(store, "songs", newest(["song_id"], "seq"))
        self.triples = Generations(store, "triples", summed(LEVELS, ["items"]))
        self.index = Generations(store, "index", lambda rows: rows.distinct())
        self.totals = Generations(store, "totals", summed(BUCKET, ["met"]))

    def _old(self, version: Version, ids: DataFrame) -> DataFrame | None:
        """The rows held for some songs; only they are combined."""
        held = self.songs.raw(version)
        return None if held is None else self.songs.combine(held.join(broadcast_if_small(ids), "song_id", "left_semi"))

    def _changes(self, version: Version, batch: DataFrame) -> DataFrame:
        """``song_id, seq``, the new levels, and the old ones as a struct, of the songs that are new or have a newer row."""
        latest = similarity.latest_per_song(batch.dropna(subset=["name", "artist", "seq"]))
        came = checkpointed(latest.select("song_id", "seq", *similarity.feature_levels()))
        old = self._old(version, came.select("song_id"))
        if old is None:
            return came.withColumn("old", F.lit(None).cast(came.select(F.struct(*LEVELS)).schema[0].dataType))
        known = old.select("song_id", F.col("seq").alias("old_seq"), F.struct(*LEVELS).alias("old"))
        joined = came.join(known, "song_id", "left").where("old_seq is null or seq > old_seq")
        return checkpointed(joined.drop("old_seq"))

    def add(self, batch: DataFrame, epoch: int) -> Version:
        with freed_checkpoints(self.store.spark):
            return self._add(batch, epoch)

    def _add(self, batch: DataFrame, epoch: int) -> Version:
        base = self.store.version()
        if epoch <= base.epoch:
            return base
        changed = self._changes(base, batch)
        gains = changed.select(*LEVELS, F.lit(1).cast("bigint").alias("items"))
        losses = changed.where("old is not null").select("old.*", F.lit(-1).cast("bigint").alias("items"))
        deltas = checkpointed(self.triples.combine(gains.unionByName(losses)))
        if deltas.isEmpty() and changed.isEmpty():
            return base
        signed, touched = self._touched(base, deltas)
        tables = {
            self.songs: changed.select("song_id", "seq", *LEVELS),
            self.triples: deltas.select(*LEVELS, "items"),
            self.index: signed.select(*BUCKET, *LEVELS),
            self.totals: self.totals.combine(touched.select(*BUCKET, F.col("items").alias("met"))),
        }
        parts = {g.table: g.added(base, rows) for g, rows in tables.items()}
        return self.store.commit(base, parts, {g.table: rows.schema for g, rows in tables.items()}, epoch)

    def _touched(self, base: Version, deltas: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The buckets of triples never seen before, and those of all triples of ``deltas`` with their change."""
        held = self.index.raw(base)
        wanted = broadcast_if_small(deltas)
        new = deltas
        if held is not None:
            seen = held.where("band = 0").join(wanted.select(*LEVELS), LEVELS, "left_semi").select(*LEVELS).distinct()
            new = deltas.join(splittable(seen, *LEVELS), LEVELS, "left_anti")
        buckets = similarity.lsh_index(new.select(F.lit(0).alias("item"), *LEVELS), self.threshold, self.mode)
        signed = checkpointed(buckets.select(*BUCKET, *LEVELS))
        mine = signed if held is None else signed.unionByName(held.distinct())
        return signed, checkpointed(mine.join(wanted, LEVELS).select(*BUCKET, *LEVELS, "items"))

    def songs_of(self, version: Version | None = None) -> DataFrame:
        """``item`` (song id) and levels of the newest row of each song."""
        return self.songs.read(version).select(F.col("song_id").alias("item"), *LEVELS)

    def buckets(self, version: Version | None = None) -> DataFrame:
        """The index: triples that songs have, with their number and their buckets."""
        version = version or self.store.version()
        return self.index.read(version).join(splittable(self.triples.read(version), *LEVELS), LEVELS).select(*LEVELS, "items", *BUCKET)

    def candidates(self, version: Version | None = None) -> DataFrame:
        """The candidate relation over all epochs, as of :func:`similarity.lsh_candidates`: buckets in which songs meet."""
        version = version or self.store.version()
        met = self.totals.read(version).where("met > 1").select(*BUCKET)
        return self.buckets(version).join(splittable(met, *BUCKET), BUCKET, "left_semi").select(*LEVELS, "items", *BUCKET)

    def met_since(self, before: Version, version: Version | None = None) -> DataFrame:
        """The part of the relation that is newer than ``before``: buckets in which a triple has gained songs, with all of their triples.

        ``fresh`` marks the triples that gained; two that did not have met before. New ones meet old ones and each other.
        """
        version = version or self.store.version()
        now = self.triples.read(version).select(*LEVELS, F.col("items").alias("now"))
        if self.triples.table in before.schemas:
            then = self.triples.read(before).select(*LEVELS, F.col("items").alias("then"))
            now = now.join(then, LEVELS, "left").where("now > coalesce(then, 0)")
        gained = checkpointed(now.select(*LEVELS))
        related = self.candidates(version).join(broadcast_if_small(gained.withColumn("_gained", F.lit(True))), LEVELS, "left")
        marked = checkpointed(related.withColumn("fresh", F.coalesce("_gained", F.lit(False))).drop("_gained"))
        where = marked.where("fresh").select(*BUCKET).distinct()
        return marked.join(splittable(where, *BUCKET), BUCKET, "left_semi").select(*LEVELS, "items", *BUCKET, "fresh")

    def similar_to(self, probes: DataFrame, verify: bool = True, version: Version | None = None) -> DataFrame:
        """Partners of the probe songs (``item`` and levels) among the songs of all epochs."""
        version = version or self.store.version()
        return similarity.similar_to(probes, self.songs_of(version), self.threshold, self.mode, verify, self.buckets(version))


def index_handler(index: SongIndex, vacuum_every: int = 64) -> Handler:
    def handle(batch: DataFrame, epoch: int) -> None:
        index.add(batch, epoch)
        if vacuum_every and epoch % vacuum_every == vacuum_every - 1:
            index.store.vacuum(keep=2)

    return handle
