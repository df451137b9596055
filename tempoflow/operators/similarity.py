"""Song similarity over three discretised features: exact Jaccard, MinHash signatures and LSH banding.

Rows with equal features are one *triple*, so everything below works on distinct triples with their item counts, and
copies are never compared with each other. Two triples are similar when they share two of three tokens (Jaccard 0.5)
or all of them (1.0). The similarity relation is kept in factored form, complete and linear: tables of keys and triples,
in which two triples are similar when they share a key, sizes of the sharing groups, and exact partner counts per item.
The items of a triple come from the item table by its levels. Listing every pair of a group would square the size of its
hottest group; partners of chosen songs are listed in full by :func:`similar_to`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import HashingTF, MinHashLSH
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions import hashing as H
from tempoflow.functions.scalars import composite_id, feature_levels, token
from tempoflow.session import broadcast_if_small, checkpointed, splittable, spread

LEVELS = ["level_0", "level_1", "level_2"]
AXIS_PAIRS = ((0, 1), (0, 2), (1, 2))
# Bands and rows that balance misses and false hits for 128 permutations.
BANDING = {0.5: (25, 5), 0.7: (14, 9)}


def latest_per_song(df: DataFrame, order: str = "seq") -> DataFrame:
    """The newest row of each name-artist id, found by an aggregate that combines before the shuffle."""
    columns = df.columns
    return (
        df.withColumn("song_id", composite_id("-"))
        .groupBy("song_id")
        .agg(F.max_by(F.struct(*columns), order).alias("_row"))
        .select("song_id", "_row.*")
    )


def feature_tokens(df: DataFrame, identity: str = "seq") -> DataFrame:
    """The three tokens of each row."""
    levels = df.select(identity, *feature_levels())
    return levels.select(identity, *[token(axis, F.col(LEVELS[axis])).alias(f"token_{axis}") for axis in range(3)])


def item_levels(df: DataFrame, identity: str = "seq") -> DataFrame:
    return df.select(F.col(identity).alias("item"), *feature_levels())


def triples(items: DataFrame) -> DataFrame:
    """Distinct feature triples with their number of items."""
    return items.groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("items"))


def shared_tokens(left: str, right: str) -> Column:
    return reduce(lambda a, b: a + b, [(F.col(f"{left}{l}") == F.col(f"{right}{l}")).cast("int") for l in LEVELS])


def jaccard(shared: Column) -> Column:
    return shared / (F.lit(6) - shared)


# ---- keys under which similar triples meet ----------------------------------------------------------------------


def pair_keys() -> Column:
    """One key per pair of tokens; two triples share a key exactly when their Jaccard is at least 0.5."""
    return F.array(
        *[
            F.concat_ws("|", F.lit(f"{a}{b}"), F.col(LEVELS[a]).cast("string"), F.col(LEVELS[b]).cast("string"))
            for a, b in AXIS_PAIRS
        ]
    )


def triple_key() -> Column:
    return F.concat_ws("|", F.lit("all"), *[F.col(l).cast("string") for l in LEVELS])


def signature(words: list[Column]) -> Column:
    """Minimum over the tokens under each permutation."""
    smaller = lambda a, b: F.least(a, b)  # noqa: E731 - zip_with accepts a lambda only
    return reduce(lambda a, b: F.zip_with(a, b, smaller), words)


def _per_band(bands: int, rows: int, build) -> Column:
    """One entry per band; ``build`` receives the band number and a function that cuts the band out of an array."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)), lambda band: build(band, lambda array: F.slice(array, band * rows + 1, rows))
    )


def band_keys(signature_col: Column, bands: int, rows: int, mode: str = H.FAST) -> Column:
    """One bucket key per band: 64 bits, or in portable mode the MD5 of the band and its minima as text."""

    def key(minima):
        def of_band(band, cut):
            if mode == H.FAST:
                return F.xxhash64(band, cut(minima))
            return F.md5(F.concat(band.cast("string"), F.lit("|"), F.array_join(cut(minima).cast("array<string>"), "-")))

        return _per_band(bands, rows, of_band)

    return H.let(signature_col, key)


def verified_keys(words: list[Column], bands: int, rows: int, threshold: float) -> Column:
    """Keys shared exactly by the triples that meet in some band *and* reach the Jaccard threshold.

    Triples that share tokens a and b meet in a band precisely if, for both, the third token wins none of its minima.
    """
    def silent_bands(silent: Column, name: Column) -> Column:
        def keys_of(flags):
            def key(band, cut):
                return F.when(F.forall(cut(flags), lambda x: x), F.concat(band.cast("string"), F.lit("|"), name))

            return F.array_compact(_per_band(bands, rows, key))

        return H.let(silent, keys_of)

    keys = [F.array(triple_key())]
    if threshold <= 0.5:
        for i, (a, b) in enumerate(AXIS_PAIRS):
            third = words[3 - a - b]
            silent = F.zip_with(signature([words[a], words[b]]), third, lambda pair, other: pair <= other)
            keys.append(silent_bands(silent, F.get(pair_keys(), F.lit(i))))
    return F.concat(*keys)


def with_signature(triple_rows: DataFrame, permutations: int = S.MINHASH_PERMUTATIONS, mode: str = H.FAST) -> DataFrame:
    """Token words and signature of each triple; every distinct token is hashed once and joined to its triples."""
    columns = triple_rows.columns
    tokens = triple_rows.select(F.explode(F.array(*[token(axis, F.col(LEVELS[axis])) for axis in range(3)])).alias("_token"))
    hashed = tokens.distinct().select("_token", H.word_array(F.col("_token"), permutations, mode).alias("_words"))
    hashed = broadcast_if_small(checkpointed(splittable(hashed, "_token")))
    worded = triple_rows
    for axis in range(3):
        words = hashed.select(F.col("_token").alias(f"_token_{axis}"), F.col("_words").alias(f"words_{axis}"))
        worded = worded.join(words, token(axis, F.col(LEVELS[axis])) == F.col(f"_token_{axis}"))
    words = [F.col(f"words_{axis}") for axis in range(3)]
    return worded.select(*columns, *words, signature(words).alias("signature"))


# ---- exact similarity -------------------------------------------------------------------------------------------


def group_pairs(triple_rows: DataFrame) -> DataFrame:
    """Per sharing key of triples with item counts: members, and the item pairs of different triples, in decimals to the end."""
    grouped = triple_rows.select("items", F.explode(pair_keys()).alias("shared_key"))
    n = F.col("items").cast("decimal(19,0)")
    total = F.col("items").cast("decimal(19,0)")
    return (
        grouped.groupBy("shared_key")
        .agg(F.count(F.lit(1)).alias("triples"), F.sum("items").alias("items"), F.sum(n * n).alias("_squares"))
        .select("shared_key", "triples", "items", ((total * total - F.col("_squares")).cast("decimal(38,0)") / 2).cast("double").alias("half_pairs"))
    )


def jaccard_groups(items: DataFrame) -> DataFrame:
    """Every group of triples that agree in two features: members, and the exact number of item pairs at Jaccard 0.5."""
    return group_pairs(triples(items))


def similar_counts(items: DataFrame) -> DataFrame:
    """Per item the exact number of partners at Jaccard 1 and at Jaccard 0.5, without forming a pair."""
    distinct = checkpointed(triples(items))
    pairs = distinct.select(*LEVELS, "items", F.explode(pair_keys()).alias("key"))
    per_key = pairs.groupBy("key").agg(F.sum("items").alias("sharing"))
    per_triple = (
        pairs.join(splittable(per_key, "key"), "key")
        .groupBy(*LEVELS)
        .agg(F.first("items").alias("items"), F.sum("sharing").alias("sharing"))
        .select(
            *LEVELS,
            (F.col("items") - 1).alias("identical"),
            (F.col("sharing") - F.col("items") * 3).alias("half_shared"),
        )
    )
    return items.join(splittable(per_triple, *LEVELS), LEVELS).select("item", "identical", "half_shared")


# ---- the similarity relation as keys ----------------------------------------------------------------------------


def song_items(df: DataFrame) -> DataFrame:
    """Song ids with their levels, the newest row of each song only: re-sent copies are not partners of each other."""
    return item_levels(latest_per_song(df), "song_id")


def jaccard_keys(items: DataFrame) -> DataFrame:
    """Key and triple: two triples have Jaccard 0.5 or more exactly when they share a key. Three rows per triple."""
    return triples(items).select(F.explode(pair_keys()).alias("key"), *LEVELS, "items")


def lsh_verified_keys(items: DataFrame, threshold: float = 0.5, mode: str = H.FAST) -> DataFrame:
    """Key and triple: two triples share a key exactly when they meet in an LSH bucket and reach the threshold."""
    bands, rows = BANDING[threshold]
    signed = with_signature(checkpointed(spread(triples(items), *LEVELS)), bands * rows, mode)
    keys = verified_keys([F.col(f"words_{axis}") for axis in range(3)], bands, rows, threshold)
    return signed.select(F.explode(keys).alias("key"), *LEVELS, "items")


# ---- index and point queries ------------------------------------------------------------------------------------


def minhash_signatures(items: DataFrame, permutations: int = S.MINHASH_PERMUTATIONS, mode: str = H.FAST) -> DataFrame:
    """Signature of every distinct triple."""
    distinct = checkpointed(spread(triples(items), *LEVELS))
    return with_signature(distinct, permutations, mode).select(*LEVELS, "items", "signature")


def lsh_index(items: DataFrame, threshold: float = 0.5, mode: str = H.FAST) -> DataFrame:
    """The LSH index as a table: bucket key and triple. Linear in the number of distinct triples."""
    bands, rows = BANDING[threshold]
    signed = minhash_signatures(items, bands * rows, mode)
    return signed.select(*LEVELS, "items", F.posexplode_outer(band_keys(F.col("signature"), bands, rows, mode)).alias("band", "bucket"))


def lsh_candidates(items: DataFrame, threshold: float = 0.5, mode: str = H.FAST) -> DataFrame:
    """The candidate relation: the buckets of the index in which two or more items meet, with all of their triples."""
    index = lsh_index(items, threshold, mode)
    met = index.groupBy("band", "bucket").agg(F.sum("items").alias("met")).where(F.col("met") > 1).drop("met")
    return index.join(splittable(met, "band", "bucket"), ["band", "bucket"], "left_semi")


def similar_to(
    probes: DataFrame,
    items: DataFrame,
    threshold: float = 0.5,
    mode: str = H.FAST,
    verify: bool = True,
    index: DataFrame | None = None,
) -> DataFrame:
    """All partners of the probe songs found through the index; an item is not its own partner.

    ``index`` is that of the items (:func:`lsh_index`), if there is one already.

    Everything is linear in the items per probe. The probe sides are broadcast only while they are measured small.
    """
    own = [f"own_{l}" for l in LEVELS]
    probes = checkpointed(probes)
    index = (lsh_index(items, threshold, mode) if index is None else index).select("bucket", *LEVELS)
    wanted = checkpointed(
        lsh_index(probes, threshold, mode).select("bucket", *[F.col(l).alias(f"own_{l}") for l in LEVELS])
    )
    met = index.join(broadcast_if_small(wanted), "bucket").select(*LEVELS, *own).distinct()
    score = jaccard(shared_tokens("own_", ""))
    scored = met.withColumn("jaccard", score)
    if verify:
        scored = scored.where(F.col("jaccard") >= threshold)
    songs = probes.select(F.col("item").alias("probe"), *[F.col(l).alias(f"own_{l}") for l in LEVELS])
    matches = checkpointed(scored.join(songs, own).select("probe", *LEVELS, "jaccard"))
    return (
        items.join(broadcast_if_small(matches), LEVELS)
        .where(F.col("item") != F.col("probe"))
        .select("probe", F.col("item").alias("similar_item"), "jaccard")
    )


def native_neighbours(items: DataFrame, probe: DataFrame, k: int = 5, tables: int = 8, seed: int = 7) -> DataFrame:
    """Spark ML's MinHash nearest-neighbour search for one song, over distinct triples.

    Only the point search of Spark ML is used: its self-join would pair whole buckets of single minima.
    """
    tokens = F.array(*[token(axis, F.col(LEVELS[axis])) for axis in range(3)])
    hashing = HashingTF(inputCol="tokens", outputCol="features", binary=True)
    data = hashing.transform(triples(items).withColumn("tokens", tokens))
    key = hashing.transform(probe.withColumn("tokens", tokens)).select("features").first()[0]
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=tables, seed=seed).fit(data)
    return model.approxNearestNeighbors(data, key, k, distCol="distance").select(*LEVELS, "items", "distance")
