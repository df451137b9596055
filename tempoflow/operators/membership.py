"""Bloom filter as a table of 32-bit words; building is one map-side combined ``bit_or``.

At most ``bits / 32`` word rows leave any task, however many items or copies there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoflow import schema as S
from tempoflow.functions import hashing as H
from tempoflow.session import checkpointed, splittable

WORD_BITS = 32
# A filter of up to this many bits travels to the executors as one literal array; larger ones are joined.
INLINE_BITS = 1 << 22


def positions(item: Column, bits: int, hashes: int, mode: str) -> Column:
    """Bit positions of an item."""
    return F.transform(H.word_array(item, hashes, mode), lambda w: F.pmod(w, F.lit(bits)))


def build(
    df: DataFrame,
    item: str = "name",
    bits: int = S.BLOOM_BITS,
    hashes: int = S.BLOOM_HASHES,
    mode: str = H.FAST,
) -> DataFrame:
    """Words with at least one set bit: (word_no, word)."""
    hits = df.where(F.col(item).isNotNull()).select(F.explode_outer(positions(F.col(item), bits, hashes, mode)).alias("position"))
    return (
        hits.groupBy(F.floor(F.col("position") / WORD_BITS).cast("bigint").alias("word_no"))
        .agg(F.bit_or(_bit("position")).alias("word"))
    )


def count_positions(
    members: DataFrame, item: str = "name", bits: int = S.BLOOM_BITS, hashes: int = S.BLOOM_HASHES, mode: str = H.FAST
) -> DataFrame:
    """Counters of a filter that can forget: ``position, n``, the sum of the members' ``n`` over their hashes.

    ``members`` has one row per item, with 1 to put it in and -1 to take it out. Counters of several tables add up, as filters do.
    """
    hits = members.where(F.col(item).isNotNull()).select("n", F.explode(positions(F.col(item), bits, hashes, mode)).alias("position"))
    return hits.groupBy("position").agg(F.sum("n").alias("n")).where("n <> 0").select("position", "n")


def words_of(counters: DataFrame) -> DataFrame:
    """The filter of the positions whose counter is above 0."""
    set_bits = counters.where("n > 0").select(F.floor(F.col("position") / WORD_BITS).cast("bigint").alias("word_no"), "position")
    return set_bits.groupBy("word_no").agg(F.bit_or(_bit("position")).alias("word"))


def merge(*tables: DataFrame) -> DataFrame:
    """OR of filters that share their parameters."""
    both = reduce(lambda a, b: a.unionByName(b), tables)
    return both.groupBy("word_no").agg(F.bit_or("word").alias("word"))


def set_positions(words: DataFrame) -> DataFrame:
    """The set bits as rows."""
    slots = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
    return (
        words.select("word_no", "word", F.explode(slots).alias("slot"))
        .where(F.expr("getbit(word, slot) = 1"))
        .select((F.col("word_no") * WORD_BITS + F.col("slot")).alias("position"))
    )


def fill(words: DataFrame, bits: int = S.BLOOM_BITS) -> DataFrame:
    used = F.coalesce(F.sum(F.bit_count("word")), F.lit(0)).cast("bigint")
    return words.agg(used.alias("bits_set")).select("bits_set", (F.col("bits_set") / F.lit(bits)).alias("fill_ratio"))


def probe(
    df: DataFrame,
    words: DataFrame,
    item: str = "name",
    bits: int = S.BLOOM_BITS,
    hashes: int = S.BLOOM_HASHES,
    mode: str = H.FAST,
    inline_bits: int = INLINE_BITS,
) -> DataFrame:
    """Rows whose item may be in the filter."""
    if bits <= inline_bits:
        return _probe_inline(df, words, item, bits, hashes, mode)
    return _probe_joined(df, words, item, bits, hashes, mode)


def _bit(position: str) -> Column:
    return F.expr(f"shiftleft(1L, cast({position} % {WORD_BITS} as int))")


def _probe_inline(df: DataFrame, words: DataFrame, item: str, bits: int, hashes: int, mode: str) -> DataFrame:
    """The whole filter as one array value: a scan with a row-level test, no shuffle of the data."""
    return df.where(_inline_hit(words, item, bits, hashes, mode))


def _inline_hit(words: DataFrame, item: str, bits: int, hashes: int, mode: str) -> Column:
    size = -(-bits // WORD_BITS)
    grid = words.sparkSession.range(size).withColumnRenamed("id", "word_no").join(words, "word_no", "left")
    packed = grid.agg(
        F.array_sort(F.collect_list(F.struct("word_no", F.coalesce("word", F.lit(0)).alias("word")))).alias("cells")
    ).select(F.transform("cells", lambda c: c["word"]))
    filter_words = packed.scalar()
    checks = []
    for i in range(hashes):
        position = F.pmod(H.word_at(F.col(item), i, mode), F.lit(bits))
        cell = F.get(filter_words, F.floor(position / WORD_BITS).cast("int"))
        checks.append(F.getbit(cell, (position % WORD_BITS).cast("int")) == 1)
    return reduce(lambda a, b: a & b, checks)


def _probe_joined(df: DataFrame, words: DataFrame, item: str, bits: int, hashes: int, mode: str) -> DataFrame:
    """For filters too large to inline: the distinct items meet the words they need, then select the rows."""
    items = df.select(F.col(item).alias("_item")).where(F.col("_item").isNotNull()).distinct()
    needed = items.select("_item", F.explode(F.array_distinct(positions(F.col("_item"), bits, hashes, mode))).alias("position"))
    needed = needed.withColumn("word_no", F.floor(F.col("position") / WORD_BITS).cast("bigint"))
    answered = needed.join(words, "word_no", "left").groupBy("_item").agg(
        F.bool_and(F.coalesce(F.col("word").bitwiseAND(_bit("position")) != 0, F.lit(False))).alias("hit")
    )
    return df.join(splittable(answered.where("hit"), "_item"), df[item] == F.col("_item"), "left_semi")


def quality(
    df: DataFrame,
    members: DataFrame,
    item: str = "name",
    bits: int = S.BLOOM_BITS,
    hashes: int = S.BLOOM_HASHES,
    mode: str = H.FAST,
) -> DataFrame:
    """Fill ratio, and false positives among the distinct items of ``df`` that are not members.

    Both inputs are reduced to one row per distinct item by a single aggregation, so copies cost nothing after it.
    """
    words = build(members, item, bits, hashes, mode)
    flagged = df.select(item, F.lit(False).alias("_member")).unionByName(members.select(item, F.lit(True).alias("_member")))
    items = flagged.where(F.col(item).isNotNull()).groupBy(item).agg(F.bool_or("_member").alias("_member"))
    strangers = items.where(~F.col("_member"))
    if bits <= INLINE_BITS:
        hit = F.count_if(_inline_hit(words, item, bits, hashes, mode)).alias("false_positives")
        counts = strangers.agg(F.count(F.lit(1)).alias("non_members"), hit)
    else:
        strangers = checkpointed(strangers)
        positives = _probe_joined(strangers, words, item, bits, hashes, mode).agg(F.count(F.lit(1)).alias("n")).scalar()
        counts = strangers.agg(F.count(F.lit(1)).alias("non_members")).select("*", positives.alias("false_positives"))
    filled = fill(words, bits)
    return counts.select(
        filled.select("bits_set").scalar().alias("bits_set"),
        filled.select("fill_ratio").scalar().alias("fill_ratio"),
        "non_members",
        "false_positives",
    )
