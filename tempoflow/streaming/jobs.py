"""The continuous jobs: each takes a stream of decoded records (with ``seq`` where order matters) and starts a query."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tempoflow import schema as S
from tempoflow.functions import hashing as H
from tempoflow.functions.scalars import above
from tempoflow.operators import clustering, distinct, membership, privacy, sampling, similarity, stats
from tempoflow.session import freed_checkpoints
from tempoflow.sources import codec
from tempoflow.sources.store import Generations, Store
from tempoflow.streaming import epochs, keyed, similar, stateful
from tempoflow.streaming.epochs import EpochTable


def dedup_stream(stream: DataFrame, delay: str = "1 hour", keys: tuple[str, ...] = ("name", "artist", "timestamp")) -> DataFrame:
    """Drop re-sent emissions that arrive within the delay."""
    return stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))


def artist_stats_console(stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Continuous artist statistics, busiest first, printed in full."""
    return epochs.start_console(stats.by_track_count(stats.artist_stats(stream)), checkpoint, trigger)


def snapshot_job(
    aggregate: DataFrame, path: str, trigger: dict | None = None
) -> tuple[StreamingQuery, EpochTable]:
    """Run any streaming aggregate in complete mode and keep its latest result."""
    table = EpochTable(f"{path}/result", aggregate.schema, slots=2)
    return epochs.start_snapshots(aggregate, table, f"{path}/checkpoint", trigger), table


def update_job(changes: DataFrame, keys: list[str], path: str, trigger: dict | None = None) -> tuple[StreamingQuery, Generations]:
    """Run a streaming aggregate, or any stream of changed rows per key, in update mode.

    An epoch writes only the groups that it has changed; the returned table reads as the newest row of each.
    """
    table = keyed.upserts(Store(changes.sparkSession, f"{path}/result"), "rows", keys)
    return epochs.start(changes, keyed.upsert_handler(table), f"{path}/checkpoint", "update", trigger), table


def dgim_state_job(stream: DataFrame, path: str, trigger: dict | None = None, **options) -> tuple[StreamingQuery, Generations]:
    """Exponential buckets with one state per key; read the result with :func:`keyed.live`."""
    return update_job(keyed.dgim_states(stream, **options), ["group", "signal"], path, trigger)


class Decoded(NamedTuple):
    """The two outputs of a decoding stream; a reader sees the same epochs in both."""

    store: Store

    def records(self) -> DataFrame:
        return self.store.read("records")

    def rejects(self) -> DataFrame:
        return self.store.read("rejects")


def decode_handler(store: Store, schema: StructType | None = None, offset: str = "offset") -> epochs.Handler:
    """Records and dead letters of each epoch in one commit: a replayed epoch adds to neither, a failed one to none."""

    def handle(batch: DataFrame, epoch: int) -> None:
        base = store.version()
        if epoch <= base.epoch:
            return
        judged = codec.judged(batch, schema, (offset,)).persist()
        try:
            outputs = {
                "records": judged.where("reason is null").select(offset, "data.*"),
                "rejects": judged.where("reason is not null").select(offset, "value", "reason"),
            }
            parts = {name: Generations(store, name, lambda rows: rows).added(base, rows) for name, rows in outputs.items()}
            store.commit(base, parts, {name: rows.schema for name, rows in outputs.items()}, epoch)
        finally:
            judged.unpersist()

    return handle


def decode_job(
    messages: DataFrame, path: str, schema: StructType | None = None, offset: str = "offset", trigger: dict | None = None
) -> tuple[StreamingQuery, Decoded]:
    """Decode a stream of messages (``value`` and their offset); what is no record is kept with its offset and the reason."""
    store = Store(messages.sparkSession, f"{path}/result")
    handler = decode_handler(store, schema, offset)
    return epochs.start(messages, handler, f"{path}/checkpoint", trigger=trigger), Decoded(store)


def similarity_job(
    stream: DataFrame, path: str, threshold: float = 0.5, mode: str = H.FAST, trigger: dict | None = None
) -> tuple[StreamingQuery, similar.SongIndex]:
    """Keep the similarity index of all songs of a stream; every epoch is compared with all before it."""
    index = similar.SongIndex(Store(stream.sparkSession, f"{path}/index"), threshold, mode)
    return epochs.start(stream, similar.index_handler(index), f"{path}/checkpoint", trigger=trigger), index


def append_job(rows: DataFrame, path: str, trigger: dict | None = None) -> tuple[StreamingQuery, str]:
    """Run a stream of final rows into a parquet folder."""
    return epochs.start_append(rows, f"{path}/result", f"{path}/checkpoint", trigger), f"{path}/result"


def reservoir_job(
    stream: DataFrame,
    path: str,
    k: int = S.RESERVOIR_SIZE,
    key: Column | None = None,
    tie: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> tuple[StreamingQuery, EpochTable]:
    table = EpochTable(f"{path}/result", stateful.reservoir_schema(stream.schema), slots=2)
    handler = stateful.reservoir_handler(table, k, key, tie)
    return epochs.start(stream, handler, f"{path}/checkpoint", trigger=trigger), table


def dgim_job(stream: DataFrame, path: str, trigger: dict | None = None, **options) -> tuple[StreamingQuery, EpochTable]:
    table = EpochTable(f"{path}/result", stateful.DGIM_STATE, slots=2)
    return epochs.start(stream, stateful.dgim_handler(table, **options), f"{path}/checkpoint", trigger=trigger), table


def unlearn_job(
    stream: DataFrame, requests, path: str, since_request: bool = False, trigger: dict | None = None
) -> tuple[StreamingQuery, EpochTable]:
    """``requests`` is called every epoch and returns the request table as it is then.

    What is forgotten by then is dropped whenever it happened: late and replayed events of a forgotten track do not pass.
    """
    table = EpochTable(f"{path}/result", stream.schema)
    handler = stateful.unlearn_handler(table, requests, since_request)
    return epochs.start(stream, handler, f"{path}/checkpoint", trigger=trigger), table


def batch_analytics(path: str, clusters: int = S.CLUSTERS, top: int = 5) -> epochs.Handler:
    """Per micro-batch: artist statistics, cluster profile (from two rows on) and trending songs, written per epoch."""

    def handle(batch: DataFrame, epoch: int) -> None:
        with freed_checkpoints(batch.sparkSession):
            report(batch, epoch)

    def report(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()
        try:
            def save(name: str, df: DataFrame) -> None:
                df.write.mode("overwrite").parquet(f"{path}/{name}/epoch={epoch}")

            save("artist_stats", stats.by_track_count(stats.artist_stats(batch)))
            save("trending", stats.trending(batch, top))
            usable = batch.dropna(subset=list(S.FEATURES))
            if usable.limit(2).count() > 1:
                clustered = clustering.kmeans_clusters(usable, k=clusters)
                save("clusters", clustering.cluster_profile(clustered))
                save("cluster_members", clustering.cluster_members(clustered))
        finally:
            batch.unpersist()

    return handle


def batch_filters(
    path: str,
    epsilon: float = S.EPSILON,
    k: int = S.K_ANONYMITY,
    bits: int = S.BLOOM_BITS,
    hashes: int = S.BLOOM_HASHES,
    popular_above: float = S.POPULAR_ABOVE,
    uniform: privacy.Uniform = privacy.fresh_uniform,
    sample_key: Column | None = None,
    mode: str = H.FAST,
) -> epochs.Handler:
    """Per micro-batch: Bloom filter and sample carried on, private averages, k-anonymous rows, similarity, top artists."""
    def handle(batch: DataFrame, epoch: int) -> None:
        with freed_checkpoints(batch.sparkSession):
            report(batch, epoch)

    def report(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            popular = membership.build(batch.where(above("popularity", popular_above)), "name", bits, hashes, mode)
            bloom = EpochTable(f"{path}/bloom", popular.schema, slots=2)
            bloom.write(membership.merge(bloom.before(spark, epoch), popular), epoch)

            candidates = sampling.keyed(batch.select("seq", "name", "artist", "popularity"), sample_key)
            sample = EpochTable(f"{path}/sample", candidates.schema, slots=2)
            sample.write(sampling.merge(sample.before(spark, epoch), candidates, tie=("seq",)), epoch)

            if batch.isEmpty():
                return

            def save(name: str, df: DataFrame) -> None:
                df.write.mode("overwrite").parquet(f"{path}/{name}/epoch={epoch}")

            save("private_stats", privacy.dp_stats(batch, epsilon, uniform))
            save("anonymous", privacy.k_anonymity(batch, k))
            items = similarity.item_levels(batch)
            first_two = items.orderBy("item").limit(2)
            save("similar", similarity.similar_to(first_two, items, mode=mode))
            save("top_artists", stats.artist_stats_top(batch))
        finally:
            batch.unpersist()

    return handle


def distinct_registers(stream: DataFrame, mode: str = H.FAST) -> DataFrame:
    """Streaming Flajolet-Martin registers, to be kept with :func:`snapshot_job`."""
    return distinct.registers(stream, mode=mode)


def popular_bloom(stream: DataFrame, popular_above: float = S.POPULAR_ABOVE, mode: str = H.FAST) -> DataFrame:
    """Streaming Bloom words of the popular tracks, to be kept with :func:`snapshot_job`."""
    return membership.build(stream.where(above("popularity", popular_above)), mode=mode)
