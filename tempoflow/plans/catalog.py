"""The registered queries: a Spark callable over a data folder and, where SQL can say it, the oracle text."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions import hashing as H
from tempoflow.functions import scalars
from tempoflow.operators import accounts, clustering, distinct, lastn, membership, privacy, sampling, similarity, stats, unlearning
from tempoflow.plans import oracle as Q
from tempoflow.plans import views as V
from tempoflow.session import stage_path
from tempoflow.sources import codec, readers, tables
from tempoflow.sources.store import Store
from tempoflow.streaming import epochs, jobs, keyed, stateful
from tempoflow.streaming.carried import Carried, Featured, Histories, Members, Releases
from tempoflow.streaming.epochs import AVAILABLE_NOW, finish
from tempoflow.streaming.similar import SongIndex

View = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def rounded(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round the double columns: sums of doubles depend on the order of the rows."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" and f.name not in skip else f.name
            for f in df.schema
        ]
    )


def timed(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text."""
    columns = columns or ("timestamp",)
    return df.withColumns({c: scalars.format_time(F.col(c)) for c in columns})


def shown(df: DataFrame) -> DataFrame:
    """Full track rows for output: time as text, and the nullable popularity as a double."""
    return timed(df.withColumn("popularity", F.col("popularity").cast("double"))).select(*tables.COLUMNS)


def _on(view: View, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(view(spark, sf_dir))


def _popular(above: int) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.where(scalars.above("popularity", above))


def _pair_totals(df: DataFrame) -> DataFrame:
    """Number of similar item pairs, from the sizes of the sharing groups."""
    items = similarity.item_levels(df)
    half = similarity.jaccard_groups(items).agg(F.coalesce(F.sum("half_pairs"), F.lit(0.0)).alias("n")).scalar()
    n = F.col("items").cast("decimal(38,0)")
    same = similarity.triples(items).agg(F.coalesce((F.sum(n * (n - 1)) / 2).cast("double"), F.lit(0.0)).alias("n"))
    return same.select(
        F.col("n").alias("identical_pairs"), half.alias("half_pairs"), (F.col("n") + half).alias("pairs")
    )


def _fm_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registers per source, and of the union by merging the registers instead of the rows."""
    events = tables.tracks(spark, sf_dir).select("name")
    orders = tables.order_plays(spark, sf_dir).select("name")
    per_source = distinct.registers(
        events.withColumn("source", F.lit("events")).unionByName(orders.withColumn("source", F.lit("orders"))),
        group=("source",),
        mode=H.PORTABLE,
    )
    union = distinct.merge([per_source.drop("source")]).withColumn("source", F.lit("all"))
    return rounded(distinct.estimate(per_source.unionByName(union), ("source",)))


def _sample(df: DataFrame) -> DataFrame:
    slim = df.select("seq", "name", "artist", F.col("popularity").cast("double").alias("popularity"))
    return sampling.reservoir_sample(slim, key=sampling.hashed_key(), tie=("seq",))


def _signature_digest(df: DataFrame) -> DataFrame:
    signed = similarity.minhash_signatures(similarity.item_levels(df), mode=H.PORTABLE)
    text = F.array_join(F.col("signature").cast("array<string>"), "-")
    return signed.select(*similarity.LEVELS, F.md5(text).alias("signature"))


def _items(operator: Callable[..., DataFrame], **options) -> Callable[[DataFrame], DataFrame]:
    return lambda df: operator(similarity.item_levels(df), **options)


def _songs(operator: Callable[..., DataFrame], **options) -> Callable[[DataFrame], DataFrame]:
    return lambda df: operator(similarity.song_items(df), **options)


def _similar_to(df: DataFrame) -> DataFrame:
    items = similarity.item_levels(df)
    return similarity.similar_to(items.orderBy("item").limit(2), items, mode=H.PORTABLE)


def _native_neighbours(df: DataFrame) -> DataFrame:
    items = similarity.item_levels(df)
    return similarity.native_neighbours(items, items.orderBy("item").limit(1))


def _latest(df: DataFrame) -> DataFrame:
    latest = timed(similarity.latest_per_song(df))
    return latest.select("song_id", "seq", F.col("popularity").cast("double").alias("popularity"), "timestamp")


def _vector(df: DataFrame) -> DataFrame:
    vector = df.select("seq", scalars.feature_array().alias("features"))
    return rounded(vector.select("seq", *[F.get("features", F.lit(i)).alias(f"f{i}") for i in range(3)]), 9)


def _kmeans_check(df: DataFrame) -> DataFrame:
    model = clustering.fit(df)
    return clustering.distance_check(clustering.assign(df, model), model)


def _cluster_check(df: DataFrame) -> DataFrame:
    """Rows by cluster profile and by membership, and distinct names over all clusters."""
    clustered = clustering.kmeans_clusters(df)
    profile = clustering.cluster_profile(clustered).agg(F.sum("songs_in_cluster").alias("n")).scalar()
    members = clustering.cluster_members(clustered)
    return members.agg(F.sum("songs").alias("member_rows"), F.count_distinct("name").alias("names")).select(
        profile.alias("profile_rows"), "member_rows", "names"
    )


def _within(estimates: DataFrame, column: str, df: DataFrame, low: float, high: float) -> DataFrame:
    """The exact number of names, and whether the estimate lies between ``low`` and ``high`` times it."""
    exact = df.agg(F.count_distinct("name").alias("n")).scalar()
    return estimates.select(exact.alias("exact_count"), F.col(column).between(exact * low, exact * high).alias("within_bound"))


def _hll_check(df: DataFrame) -> DataFrame:
    exact = df.groupBy("artist").agg(F.count_distinct("name").alias("exact_count"))
    close = lambda c: F.abs(F.col(c) - F.col("exact_count")) <= F.greatest(F.lit(2.0), F.col("exact_count") * 0.2)
    joined = distinct.native_estimate(df, group=("artist",)).join(exact, "artist")
    return joined.select("artist", "exact_count", (close("approx_count") & close("hll_count")).alias("within_bound"))


def _ml_lsh_check(df: DataFrame) -> DataFrame:
    """Of the neighbours that Spark ML returns: how many, how many at distance 0, how many whose distance is not the exact one."""
    items = similarity.item_levels(df)
    probe = items.orderBy("item").limit(1).select(*[F.col(c).alias(f"own_{c}") for c in similarity.LEVELS])
    found = similarity.native_neighbours(items, items.orderBy("item").limit(1)).join(F.broadcast(probe))
    exact = F.lit(1.0) - similarity.jaccard(similarity.shared_tokens("own_", ""))
    return found.agg(
        F.count_if(F.col("distance") == 0).alias("identical"), F.count_if(F.abs(F.col("distance") - exact) > 1e-9).alias("wrong")
    )


def _cut_short() -> Column:
    """Every third message is cut short."""
    return F.when(F.col("event_id") % 3 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that the decoder refuses, and how many messages it takes."""
    events, cut = tables.table(spark, sf_dir, "events"), _cut_short()
    good, bad = codec.decode_with_rejects(events.select(cut.alias("value")), _props_schema())
    decoded = good.agg(F.lit("decoded").alias("value"), F.count(F.lit(1)).alias("messages"))
    return bad.groupBy("value").agg(F.count(F.lit(1)).alias("messages")).unionByName(decoded)


def _with_requests(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(tables.tracks(spark, sf_dir), V.forget_requests(spark, sf_dir))


def _bloom_words(df: DataFrame) -> DataFrame:
    return membership.build(df.where(scalars.above("popularity", S.POPULAR_ABOVE)), mode=H.PORTABLE)


# Nearly every track is popular at some time, so the probing queries take members by name, to leave strangers to test.
_MARKED = "name LIKE '%7'"


def _record_queries() -> dict[str, Query]:
    t, view = tables.tracks, V.TRACKS
    rows = lambda text: Q.over(view, select=text)
    return {
        "json_decode": Query(
            lambda s, d: codec.decode(
                tables.table(s, d, "events").withColumnRenamed("props", "value_text").select("event_id", F.col("value_text").alias("value")),
                _props_schema(),
                keep=("event_id",),
            ),
            "SELECT event_id, regexp_extract(props, '([0-9]+)', 1)::INTEGER AS k FROM events",
        ),
        "json_encode": Query(
            _on(t, lambda df: shown(codec.decode(codec.encode(df, keep=("seq",)), keep=("seq",)))),
            rows(Q.TRACK_ROWS),
        ),
        "flatten_items": Query(tables.flattened_playlists, Q.FLATTEN),
        "popular_gt80": Query(_on(t, lambda df: _popular(S.POPULAR_ABOVE)(df).select("seq", "name")), rows("SELECT seq, name FROM tracks WHERE popularity > 80")),
        "popular_gt90": Query(_on(t, lambda df: _popular(S.VERY_POPULAR_ABOVE)(df).select("seq", "name")), rows("SELECT seq, name FROM tracks WHERE popularity > 90")),
        "threshold_bits": Query(
            _on(t, lambda df: df.select("seq", scalars.composite_id(" by ").alias("track"), *[c.alias(n) for n, c in scalars.signal_bits().items()])),
            Q.over(view, Q.BITS, select=Q.THRESHOLD_BITS),
        ),
        "feature_vector": Query(_on(t, _vector), rows(Q.FEATURE_VECTOR)),
        "discretise": Query(_on(t, lambda df: df.select("seq", *scalars.feature_levels())), Q.over(view, Q.levels(), select=Q.DISCRETISE)),
        "track_ids": Query(
            _on(t, lambda df: df.select("seq", scalars.composite_id("-").alias("song_id"), scalars.composite_id(" by ").alias("track"))),
            rows("SELECT seq, name || '-' || artist AS song_id, name || ' by ' || artist AS track FROM tracks"),
        ),
        "ts_roundtrip": Query(
            _on(t, lambda df: df.select("seq", scalars.format_time(scalars.parse_time(scalars.format_time(F.col("timestamp")))).alias("timestamp"))),
            rows(f"SELECT seq, {Q.TIME} AS timestamp FROM tracks"),
        ),
        "dedup_emissions": Query(_on(t, lambda df: timed(stats.dedup_emissions(df.unionByName(df)).select("name", "artist", "timestamp"))), f"WITH {view.strip()}\nSELECT name, artist, {Q.TIME} AS timestamp FROM (SELECT DISTINCT name, artist, timestamp FROM tracks)"),
    }


def _props_schema():
    from pyspark.sql.types import IntegerType, StructField, StructType

    return StructType([StructField("k", IntegerType())])


def _stats_queries(suffix: str, source: View, view: str, has_seq: bool) -> dict[str, Query]:
    on = lambda operator: _on(source, operator)
    rows = lambda text, *ctes: Q.over(view, *ctes, select=text)
    found = {
        "artist_stats": Query(on(lambda df: rounded(stats.by_track_count(stats.artist_stats(df)))), rows(Q.ARTIST_STATS)),
        "artist_stats_top5": Query(on(stats.artist_stats_top), rows(Q.ARTIST_STATS_TOP)),
        "global_stats": Query(on(lambda df: rounded(stats.global_stats(df))), rows(Q.GLOBAL_STATS)),
        "top_artists": Query(on(stats.top_artists), rows(Q.TOP_ARTISTS)),
        "exact_distinct": Query(on(stats.exact_distinct), rows("SELECT count(DISTINCT name) AS exact_count FROM tracks")),
        "feature_corr": Query(on(lambda df: rounded(stats.feature_correlation(df))), rows(Q.FEATURE_CORR)),
        "artist_distribution": Query(on(lambda df: rounded(stats.distribution(df), 9)), rows(Q.DISTRIBUTION)),
        "track_history": Query(on(lambda df: timed(stats.track_history(df), "last_seen")), rows(Q.TRACK_HISTORY)),
        "fm_estimate": Query(
            on(lambda df: rounded(distinct.estimate(distinct.registers(df, mode=H.PORTABLE)))), rows(Q.FM_ESTIMATE, Q.FM_ZEROS)
        ),
        "fm_by_group": Query(
            on(lambda df: rounded(distinct.estimate(distinct.registers(df, group=("artist",), mode=H.PORTABLE), ("artist",)))),
            rows(Q.FM_BY_GROUP, Q.FM_ZEROS),
        ),
        "fm_error": Query(on(lambda df: rounded(distinct.error(df, mode=H.PORTABLE))), rows(Q.FM_ERROR, Q.FM_ZEROS)),
        "fm_fast": Query(on(lambda df: distinct.estimate(distinct.registers(df, mode=H.FAST)))),
        "hll_estimate": Query(on(lambda df: distinct.native_estimate(df, group=("artist",)))),
        "bloom_build": Query(on(_bloom_words), rows(Q.BLOOM_WORDS, Q.bloom())),
        "bloom_fpr": Query(on(lambda df: membership.quality(df, df.where(_MARKED), mode=H.PORTABLE)), rows(Q.BLOOM_FPR, Q.bloom(_MARKED))),
        "dp_stats": Query(on(lambda df: rounded(privacy.dp_stats(df, uniform=privacy.hashed_uniform(7)))), rows(Q.DP_STATS)),
        "dp_artist_stats": Query(
            on(lambda df: rounded(privacy.dp_artist_stats(df, uniform=privacy.hashed_uniform(7)))),
            rows(Q.DP_ARTIST_SELECT, Q.DP_ARTIST_STATS),
        ),
        "jaccard_groups": Query(on(lambda df: similarity.jaccard_groups(df.select(*scalars.feature_levels()))), rows(Q.JACCARD_GROUPS, Q.levels(None))),
        "minhash_signature": Query(
            on(lambda df: _signature_digest(df.withColumn("seq", F.lit(0)))), rows(Q.MINHASH, Q.levels(None), Q.signatures(S.MINHASH_PERMUTATIONS))
        ),
        "lsh_index": Query(
            on(lambda df: similarity.lsh_index(df.select(*scalars.feature_levels()), mode=H.PORTABLE)),
            rows(Q.LSH_INDEX, Q.levels(None), Q.banded()),
        ),
        "cluster_profile": Query(on(lambda df: clustering.cluster_profile(clustering.kmeans_clusters(df)))),
        "cluster_members": Query(on(lambda df: clustering.cluster_members(clustering.kmeans_clusters(df)))),
        "kmeans_check": Query(on(_kmeans_check), rows(Q.KMEANS_CHECK)),
        "cluster_check": Query(on(_cluster_check), rows(Q.CLUSTER_CHECK)),
        "fm_fast_check": Query(
            on(lambda df: _within(distinct.estimate(distinct.registers(df, mode=H.FAST)), "estimate", df, 0.5, 2.5)), rows(Q.COUNT_CHECK)
        ),
        "hll_check": Query(on(_hll_check), rows(Q.HLL_CHECK)),
    }
    if has_seq:
        found |= {
            "trending_top5": Query(on(stats.trending), rows(Q.TRENDING)),
            "bloom_probe": Query(
                on(lambda df: membership.probe(df, membership.build(df.where(_MARKED), mode=H.PORTABLE), mode=H.PORTABLE).select("seq", "name")),
                rows(Q.BLOOM_PROBE, Q.bloom(_MARKED)),
            ),
            "reservoir_sample": Query(on(_sample), rows(Q.RESERVOIR)),
            "window_ones_exact": Query(on(lastn.window_ones), rows(Q.WINDOW_ONES, Q.BITS)),
            "dgim_stats": Query(on(lastn.dgim_stats), rows(Q.DGIM_STATS.format(key="a.k AS artist, "), Q.BITS, Q.dgim("artist"))),
            "dgim_overall": Query(on(lastn.dgim_overall), rows(Q.DGIM_STATS.format(key=""), Q.BITS, Q.dgim("'all'"))),
            "dgim_timeline": Query(
                on(lambda df: lastn.dgim_timeline(df, bits={"energy": scalars.signal_bits()["energy"]})),
                rows(Q.DGIM_TIMELINE_SELECT, Q.BITS, Q.DGIM_TIMELINE),
            ),
            "k_anonymity": Query(on(privacy.k_anonymity), rows("SELECT * FROM anonymous", Q.K_ANONYMITY)),
            "k_anonymity_7": Query(on(lambda df: privacy.k_anonymity(df, 7)), rows("SELECT * FROM anonymous", Q.k_anonymity(7))),
            "k_anonymity_check": Query(
                on(lambda df: privacy.k_anonymity_check(privacy.k_anonymity(df))), rows(Q.K_ANONYMITY_CHECK, Q.K_ANONYMITY)
            ),
            "kmeans_clusters": Query(on(lambda df: clustering.kmeans_clusters(df).select("seq", "cluster"))),
        }
    return {name + suffix: query for name, query in found.items()}


def _track_queries() -> dict[str, Query]:
    t, view = tables.tracks, V.TRACKS
    rows = lambda text, *ctes: Q.over(view, *ctes, select=text)
    key = "artist"
    return {
        "running_total": Query(_on(t, stats.running_total), rows("SELECT count(*) AS total_tracks FROM tracks")),
        "fm_registers": Query(_on(t, lambda df: distinct.long_registers(distinct.registers(df, mode=H.PORTABLE))), rows(Q.FM_REGISTERS, Q.FM_ZEROS)),
        "fm_explain": Query(_on(t, lambda df: distinct.explain_items(df, mode=H.PORTABLE)), rows(Q.FM_EXPLAIN, Q.FM_ZEROS)),
        "trailing_zeros": Query(
            _on(t, lambda df: df.select("seq", H.trailing_zeros(H.word_at(F.col("name"), 0, H.PORTABLE)).alias("trailing_zeros"))),
            rows(f"SELECT seq, {Q.TRAILING} AS trailing_zeros FROM (SELECT seq, {Q.word('name', '0')} AS w FROM tracks)"),
        ),
        "fm_merge": Query(_fm_merge, Q.FM_MERGE),
        "bloom_positions": Query(_on(t, lambda df: membership.set_positions(_bloom_words(df))), rows(Q.BLOOM_BITS, Q.bloom())),
        "dgim_buckets": Query(
            _on(t, lambda df: lastn.dgim_buckets(df, scalars.signal_bits()["energy"])), rows(Q.DGIM_BUCKETS, Q.BITS, Q.dgim(key))
        ),
        "feature_tokens": Query(_on(t, similarity.feature_tokens), rows(Q.TOKENS, Q.levels())),
        "latest_tracks": Query(_on(t, _latest), rows(Q.LATEST)),
        "jaccard_pair_totals": Query(_on(t, _pair_totals), rows(Q.PAIR_TOTALS, Q.levels(), Q.PAIRS)),
        "similar_counts": Query(_on(t, _items(similarity.similar_counts)), rows(Q.SIMILAR_COUNTS, Q.levels(), Q.PAIRS)),
        "song_levels": Query(_on(t, lambda df: similarity.song_items(df).withColumnRenamed("item", "song_id")), rows(Q.SONG_LEVELS, Q.SONGS, Q.song_levels())),
        "jaccard_keys": Query(_on(t, _songs(similarity.jaccard_keys)), rows(Q.JACCARD_KEYS, Q.SONGS, Q.song_levels())),
        "lsh_candidates": Query(
            _on(t, _songs(similarity.lsh_candidates, mode=H.PORTABLE)), rows(Q.LSH_CANDIDATES, Q.SONGS, Q.song_levels(), Q.banded())
        ),
        "lsh_verified": Query(
            _on(t, _songs(similarity.lsh_verified_keys, mode=H.PORTABLE)),
            rows(Q.VERIFIED_KEYS, Q.SONGS, Q.song_levels(), Q.signatures(125), Q.SILENT),
        ),
        "lsh_candidates_all": Query(
            _on(t, _items(similarity.lsh_candidates, mode=H.PORTABLE)), rows(Q.LSH_CANDIDATES, Q.levels(), Q.banded())
        ),
        "lsh_verified_all": Query(
            _on(t, _items(similarity.lsh_verified_keys, mode=H.PORTABLE)),
            rows(Q.VERIFIED_KEYS, Q.levels(), Q.signatures(125), Q.SILENT),
        ),
        "lsh_strict": Query(
            _on(t, _items(similarity.lsh_candidates, threshold=0.7, mode=H.PORTABLE)),
            rows(Q.LSH_CANDIDATES, Q.levels(), Q.banded(14, 9)),
        ),
        "similar_to": Query(_on(t, _similar_to), rows(Q.SIMILAR_TO, Q.levels(), Q.banded(), Q.CANDIDATES)),
        "ml_lsh_neighbours": Query(_on(t, _native_neighbours)),
        "ml_lsh_check": Query(_on(t, _ml_lsh_check), "SELECT 1::BIGINT AS identical, 0::BIGINT AS wrong"),
        "json_rejects": Query(_rejects, Q.REJECTS),
        "windowed_artist_stats": Query(
            _on(t, lambda df: rounded(timed(stats.windowed_stats(df), "window_start"))), rows(Q.TUMBLING)
        ),
        "sliding_artist_stats": Query(
            _on(t, lambda df: rounded(timed(stats.windowed_stats(df, "24 hours", "12 hours"), "window_start"))), rows(Q.SLIDING)
        ),
        "session_artist_stats": Query(
            _on(t, lambda df: rounded(timed(stats.session_stats(df), "session_start", "session_end"))), rows(Q.SESSIONS)
        ),
    }


def _unlearning_queries() -> dict[str, Query]:
    rows = lambda text: Q.over(V.TRACKS, Q.GONE, select=text)

    def verified(df: DataFrame, requests: DataFrame) -> DataFrame:
        processed = unlearning.drop_forgotten(df, requests, since_request=True)
        return timed(unlearning.verify_tracks(df, processed, requests), "last_seen")

    def residue(df: DataFrame, requests: DataFrame) -> DataFrame:
        stored = unlearning.drop_forgotten(df, requests, since_request=True)
        return unlearning.residue(stored, unlearning.drop_forgotten(stored, requests), requests)

    def history(df: DataFrame, requests: DataFrame) -> Store:
        """What was lawful at each time, stored, and then purged of all that was forgotten since."""
        store = Store(df.sparkSession, stage_path(df.sparkSession, "history"))
        lawful = unlearning.drop_forgotten(df, requests, since_request=True)
        store.append("tracks", lawful.repartitionByRange("artist", "name"))
        unlearning.purge(store, "tracks", requests)
        return store

    def audit(df: DataFrame, requests: DataFrame) -> DataFrame:
        store = history(df, requests)
        return unlearning.residue(store.read("tracks", store.version(1)), store.read("tracks"), requests)

    return {
        "forget_filter": Query(_with_requests(lambda df, r: unlearning.drop_forgotten(df, r).select("seq", "name", "artist")), rows(Q.FORGET_FILTER)),
        "mask_features": Query(_on(tables.tracks, lambda df: shown(privacy.mask_features(df, ["danceability", "tempo"]))), Q.over(V.TRACKS, select=Q.MASKED)),
        "unlearn_apply": Query(_with_requests(lambda df, r: shown(unlearning.unlearn(df, r))), rows(Q.UNLEARN_APPLY)),
        "unlearn_since_request": Query(_with_requests(lambda df, r: shown(unlearning.unlearn(df, r, since_request=True))), rows(Q.UNLEARN_SINCE)),
        "active_tracks": Query(_with_requests(lambda df, r: shown(unlearning.active_tracks(df, r))), rows(Q.ACTIVE_TRACKS)),
        "audit_summary": Query(
            lambda s, d: timed(unlearning.audit_summary(V.forget_requests(s, d)), "first_request", "last_request"), rows(Q.AUDIT)
        ),
        "unlearn_status": Query(_with_requests(unlearning.status), rows(Q.STATUS)),
        "unlearn_verify_all": Query(_with_requests(unlearning.verify_all), rows(Q.VERIFY_ALL)),
        "unlearn_verify": Query(_with_requests(verified), rows(Q.VERIFY)),
        "unlearn_residue": Query(_with_requests(residue), rows(Q.RESIDUE)),
        "unlearn_purge": Query(_with_requests(lambda df, r: shown(history(df, r).read("tracks"))), rows(Q.PURGED)),
        "unlearn_purge_audit": Query(_with_requests(audit), rows(Q.RESIDUE)),
    }


def _track_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.tracks_from_events(readers.stream_table(spark, sf_dir, "events"))


def _snapshot(build: Callable[[DataFrame], DataFrame], show: Callable[[DataFrame], DataFrame]):
    """Run a streaming aggregate over the whole table and return what its last epoch left."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        query, table = jobs.snapshot_job(build(_track_stream(spark, sf_dir)), stage_path(spark, "stream"), AVAILABLE_NOW)
        finish(query)
        return show(table.latest(spark))

    return run


def _appended(build: Callable[[DataFrame], DataFrame], show: Callable[[DataFrame], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = build(_track_stream(spark, sf_dir))
        query, path = jobs.append_job(rows, stage_path(spark, "stream"), AVAILABLE_NOW)
        finish(query)
        return show(spark.read.schema(rows.schema).parquet(path))

    return run


def _stream_reservoir(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = _track_stream(spark, sf_dir).select("seq", "name", "artist", F.col("popularity").cast("double").alias("popularity"))
    query, table = jobs.reservoir_job(
        slim, stage_path(spark, "stream"), key=sampling.hashed_key(), tie=("seq",), trigger=AVAILABLE_NOW
    )
    finish(query)
    return table.latest(spark).drop(sampling.KEY)


def _stream_dgim(spark: SparkSession, sf_dir: str) -> DataFrame:
    query, table = jobs.dgim_job(_track_stream(spark, sf_dir), stage_path(spark, "stream"), AVAILABLE_NOW)
    finish(query)
    return stateful.dgim_estimates(table.latest(spark)).withColumnRenamed("group", "artist")


def _stream_dgim_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    query, table = jobs.dgim_state_job(_track_stream(spark, sf_dir), stage_path(spark, "stream"), AVAILABLE_NOW)
    finish(query)
    return stateful.dgim_estimates(keyed.live(table)).withColumnRenamed("group", "artist")


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the decoder refuses in a stream, with reason, and how many messages it takes; some have numbers as text, some are missing."""
    events = readers.stream_table(spark, sf_dir, "events")
    key = F.col("event_id")
    odd = F.when(key % 7 == 1, '{"k": "seven"}').when(key % 7 == 2, "").when(key % 7 == 3, F.lit(None)).otherwise(_cut_short())
    query, outputs = jobs.decode_job(events.select(key.alias("offset"), odd.alias("value")), stage_path(spark, "stream"), _props_schema(), trigger=AVAILABLE_NOW)
    finish(query)
    decoded = outputs.records().agg(
        F.lit("decoded").alias("reason"), F.count(F.lit(1)).alias("messages"), F.sum("offset").alias("offsets"), F.sum("k").alias("k")
    )
    refused = outputs.rejects().groupBy("reason").agg(F.count(F.lit(1)).alias("messages"), F.sum("offset").alias("offsets"))
    return refused.withColumn("k", F.lit(0).cast("bigint")).unionByName(decoded)


def _stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlist items joined with their audio features as both stream in; features are missing for some and too late for others."""
    lines = lambda: readers.stream_table(spark, sf_dir, "lineitem")
    documents = tables.documents_from_lines(lines(), F.col("l_shipdate").cast("timestamp").alias("timestamp"))
    items = codec.flatten_items(codec.decode(documents, S.PLAYLIST_SCHEMA, keep=("timestamp",)), keep=("timestamp",))
    path = stage_path(spark, "stream")
    featured = Featured(Store(spark, f"{path}/result"), wait="6 hours", delay="24 hours 30 minutes")
    stream = featured.sides(items, tables.measured_features(lines()))
    finish(epochs.start(stream, featured.handler(), f"{path}/checkpoint", trigger=AVAILABLE_NOW))
    return timed(rounded(featured.rows(), 9))


def _carried(build: Callable[[Store, SparkSession, str], Carried], show: Callable[..., DataFrame]):
    """Run what a stream carries over its epochs over the whole table and return what is left at the end."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = stage_path(spark, "stream")
        carried = build(Store(spark, f"{path}/result"), spark, sf_dir)
        finish(epochs.start(_track_stream(spark, sf_dir), carried.handler(), f"{path}/checkpoint", trigger=AVAILABLE_NOW))
        return show(carried)

    return run


def _histories(store: Store, spark: SparkSession, sf_dir: str) -> Histories:
    return Histories(store, lambda: V.forget_requests(spark, sf_dir))


def _members(store: Store, spark: SparkSession, sf_dir: str) -> Members:
    return Members(store, lambda: V.forget_requests(spark, sf_dir), mode=H.PORTABLE)


def _release_check(releases: Releases) -> DataFrame:
    """Whether all classes are large enough, and the rows that came out or wait."""
    check, held = privacy.k_anonymity_check(releases.rows()), releases.held().agg(F.count(F.lit(1)).alias("n")).scalar()
    return check.select(
        (F.col("smallest_class") >= releases.k).alias("large_enough"), (held < releases.k).alias("few_held"), (F.col("rows_kept") + held).alias("rows_seen")
    )


def _day() -> Column:
    """Days since the end of 2023: the steps of the running sums."""
    return F.datediff(F.col("timestamp"), F.lit("2023-12-31")).cast("bigint")


def _song_index(spark: SparkSession, sf_dir: str, every_row: bool = False) -> SongIndex:
    """The index of the songs of the stream, or of all its rows as songs of their own."""
    stream = _track_stream(spark, sf_dir)
    if every_row:
        stream = stream.withColumn("name", F.concat("name", F.lit("#"), F.col("seq").cast("string")))
    query, index = jobs.similarity_job(stream, stage_path(spark, "stream"), mode=H.PORTABLE, trigger=AVAILABLE_NOW)
    finish(query)
    return index


def _stream_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _song_index(spark, sf_dir, every_row=True)
    return index.similar_to(index.songs_of().orderBy("item").limit(2))


def _updated(build: Callable[[DataFrame], DataFrame], keys: list[str], show: Callable[[DataFrame], DataFrame]):
    """Run a streaming aggregate in update mode over the whole table and return the newest row of each group."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        query, table = jobs.update_job(build(_track_stream(spark, sf_dir)), keys, stage_path(spark, "stream"), AVAILABLE_NOW)
        finish(query)
        return show(table.read().drop("epoch"))

    return run


def _stream_unlearn(spark: SparkSession, sf_dir: str) -> DataFrame:
    query, table = jobs.unlearn_job(
        _track_stream(spark, sf_dir), lambda: V.forget_requests(spark, sf_dir), stage_path(spark, "stream"), trigger=AVAILABLE_NOW
    )
    finish(query)
    return shown(table.all(spark))


def _analytics_report(name: str, combine: Callable[[DataFrame], DataFrame]):
    """One report of the micro-batch analytics over the whole table, combined over all epochs, however the rows were cut."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = stage_path(spark, "stream")
        finish(epochs.start(_track_stream(spark, sf_dir), jobs.batch_analytics(path), f"{path}/checkpoint", trigger=AVAILABLE_NOW))
        return combine(spark.read.parquet(f"{path}/{name}").drop("epoch"))

    return run


def _filters_report(name: str):
    """What the micro-batch filters carry from epoch to epoch, after the last one."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = stage_path(spark, "stream")
        handler = jobs.batch_filters(path, uniform=privacy.hashed_uniform(7), sample_key=sampling.hashed_key(), mode=H.PORTABLE)
        finish(epochs.start(_track_stream(spark, sf_dir), handler, f"{path}/checkpoint", trigger=AVAILABLE_NOW))
        stored = spark.read.parquet(f"{path}/{name}")
        rows = stored.where(F.col("epoch") == stored.agg(F.max("epoch")).scalar()).drop("epoch", "slot", sampling.KEY)
        return rows.withColumn("popularity", F.col("popularity").cast("double")) if name == "sample" else rows

    return run


def _wire(stream: DataFrame) -> DataFrame:
    """Records to JSON messages and back inside one stream."""
    return codec.decode(codec.encode(stream, keep=("seq",)), keep=("seq",))


def _stream_queries() -> dict[str, Query]:
    rows = lambda text, *ctes: Q.over(V.TRACKS, *ctes, select=text)
    late = lambda df: df.withWatermark("timestamp", "1 day")
    sessions = lambda df: stats.session_stats_stream(late(df)).drop("avg_popularity")
    dgim_sql = Q.DGIM_STATS.format(key="a.k AS artist, ")
    return {
        "stream_artist_stats": Query(_snapshot(stats.artist_stats, lambda df: rounded(stats.by_track_count(df))), rows(Q.ARTIST_STATS)),
        "stream_total": Query(_snapshot(stats.running_total, lambda df: df), rows("SELECT count(*) AS total_tracks FROM tracks")),
        "stream_fm": Query(
            _snapshot(lambda df: jobs.distinct_registers(df, H.PORTABLE), lambda df: rounded(distinct.estimate(df))),
            rows(Q.FM_ESTIMATE, Q.FM_ZEROS),
        ),
        "stream_bloom": Query(_snapshot(lambda df: jobs.popular_bloom(df, mode=H.PORTABLE), lambda df: df), rows(Q.BLOOM_WORDS, Q.bloom())),
        "stream_windowed_stats": Query(
            _appended(lambda df: stats.windowed_stats(late(df)), lambda df: rounded(timed(df, "window_start"))),
            rows(Q.closed(Q.TUMBLING, "window_start", "24 HOURS")),
        ),
        "stream_sliding_stats": Query(
            _appended(lambda df: stats.windowed_stats(late(df), "24 hours", "12 hours"), lambda df: rounded(timed(df, "window_start"))),
            rows(Q.closed(Q.SLIDING, "window_start", "24 HOURS")),
        ),
        "stream_session_stats": Query(
            _appended(sessions, lambda df: timed(df, "session_start")),
            rows(f"SELECT session_start, artist, track_count FROM ({Q.closed(Q.SESSIONS, 'session_end', '30 MINUTES')})"),
        ),
        "stream_json_decode": Query(_appended(_wire, shown), rows(Q.TRACK_ROWS)),
        "stream_dedup": Query(
            _appended(lambda df: jobs.dedup_stream(df.unionByName(df)), lambda df: timed(df.select("name", "artist", "timestamp"))),
            rows(f"SELECT name, artist, {Q.TIME} AS timestamp FROM (SELECT DISTINCT name, artist, timestamp FROM tracks)"),
        ),
        "stream_reservoir": Query(_stream_reservoir, rows(Q.RESERVOIR)),
        "stream_dgim": Query(
            _stream_dgim,
            rows(
                f"SELECT artist, signal, estimated_count, current_position, bucket_count FROM ({dgim_sql})",
                Q.BITS,
                Q.dgim("artist"),
            ),
        ),
        "stream_dgim_state": Query(
            _stream_dgim_state,
            rows(
                f"SELECT artist, signal, estimated_count, current_position, bucket_count FROM ({dgim_sql})",
                Q.BITS,
                Q.dgim("artist"),
            ),
        ),
        "stream_artist_updates": Query(
            _updated(stats.artist_stats, ["artist"], lambda df: rounded(stats.by_track_count(df))), rows(Q.ARTIST_STATS)
        ),
        "stream_fm_updates": Query(
            _updated(
                lambda df: distinct.registers(df, group=("artist",), mode=H.PORTABLE), ["artist"], lambda df: rounded(distinct.estimate(df, ("artist",)))
            ),
            rows(Q.FM_BY_GROUP, Q.FM_ZEROS),
        ),
        "stream_lsh_candidates": Query(
            lambda s, d: _song_index(s, d).candidates(), rows(Q.LSH_CANDIDATES, Q.SONGS, Q.song_levels(), Q.banded())
        ),
        "stream_lsh_candidates_all": Query(
            lambda s, d: _song_index(s, d, every_row=True).candidates(), rows(Q.LSH_CANDIDATES, Q.levels(), Q.banded())
        ),
        "stream_similar": Query(_stream_similar, rows(Q.SIMILAR_TO, Q.levels("name || '#' || seq || '-' || artist"), Q.banded(), Q.CANDIDATES)),
        "stream_active": Query(_carried(_histories, lambda c: shown(c.active_tracks())), rows(Q.ACTIVE_TRACKS, Q.GONE)),
        "stream_history": Query(_carried(_histories, lambda c: timed(c.track_history(), "last_seen")), rows(Q.KEPT_HISTORY, Q.GONE)),
        "stream_status": Query(_carried(_histories, lambda c: c.status()), rows(Q.STATUS, Q.GONE)),
        "bloom_forget": Query(_carried(_members, lambda c: c.words()), rows(Q.BLOOM_WORDS, Q.GONE, Q.bloom().replace("FROM tracks", "FROM kept"))),
        "stream_anonymous": Query(_carried(lambda store, s, d: Releases(store, 7), _release_check), rows(Q.RELEASE_CHECK)),
        "dp_running_stats": Query(
            _on(tables.tracks, lambda df: rounded(accounts.dp_running_stats(df, _day(), 40, uniform=privacy.hashed_uniform(7)), 5)), rows(Q.DP_RUNNING)
        ),
        "stream_json_rejects": Query(_stream_rejects, Q.STREAM_REJECTS),
        "stream_flatten": Query(_stream_flatten, Q.STREAM_FLATTEN),
        "stream_unlearn": Query(_stream_unlearn, rows(Q.UNLEARN_APPLY, Q.GONE)),
        "stream_batch_analytics": Query(_analytics_report("trending", stats.trending), rows(Q.TRENDING)),
        "stream_batch_artists": Query(
            _analytics_report("artist_stats", lambda df: df.groupBy("artist").agg(F.sum("track_count").alias("track_count"))),
            rows("SELECT artist, count(*) AS track_count FROM tracks GROUP BY artist"),
        ),
        "stream_batch_members": Query(
            _analytics_report("cluster_members", lambda df: df.groupBy("name").agg(F.sum("songs").alias("songs"))),
            rows("SELECT name, count(*) AS songs FROM tracks GROUP BY name"),
        ),
        "stream_batch_filters": Query(_filters_report("bloom"), rows(Q.BLOOM_WORDS, Q.bloom())),
        "stream_batch_sample": Query(_filters_report("sample"), rows(Q.RESERVOIR)),
    }


def catalog() -> dict[str, Query]:
    found = _record_queries()
    found |= _stats_queries("", tables.tracks, V.TRACKS, has_seq=True)
    found |= _track_queries()
    found |= _unlearning_queries()
    found |= _stream_queries()
    found |= _stats_queries("_orders", tables.order_plays, V.ORDERS, has_seq=True)
    found |= _stats_queries("_lines", tables.line_plays, V.LINES, has_seq=False)
    return found
