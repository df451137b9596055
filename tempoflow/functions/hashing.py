"""Families of hash words over text values.

A value is digested once to a base number, and every member of a family is a cheap function of that base:

``PORTABLE``  base from MD5, word i = base * g^(i+1) modulo the prime 2^31 - 1. Multiplication is a permutation of the
              non-zero residues, and any SQL engine with MD5 and 64-bit integers can repeat it.
``FAST``      base from xxHash64, word i = xxHash64 of (i, base): 63-bit words for very large inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PORTABLE = "portable"
FAST = "fast"

# The Mersenne prime 2^31 - 1 and the multiplier of the "minimal standard" generator.
PRIME = 2147483647
GENERATOR = 48271
_MAX_LONG = (1 << 63) - 1
_ZERO_WORD_BIT = 1 << 32


def multipliers(count: int) -> list[int]:
    """The first powers of the generator."""
    return [pow(GENERATOR, i + 1, PRIME) for i in range(count)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def base(value: Column, mode: str = FAST) -> Column:
    """Base number of a value; null stays null."""
    text = value.cast("string")
    if mode == PORTABLE:
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(PRIME - 1) + F.lit(1)
    return F.when(text.isNotNull(), F.xxhash64(text))


def word(base_col: Column, index: int, mode: str = FAST) -> Column:
    """Word ``index`` of the family as a non-negative bigint."""
    if mode == PORTABLE:
        return base_col * F.lit(multipliers(index + 1)[-1]) % F.lit(PRIME)
    return F.when(base_col.isNotNull(), F.xxhash64(F.lit(index), base_col).bitwiseAND(F.lit(_MAX_LONG)))


def word_sql(base_name: str, index: int, mode: str = FAST) -> str:
    """The same as SQL text over a base column, for plans that need many words."""
    if mode == PORTABLE:
        return f"({base_name} * {multipliers(index + 1)[-1]}L % {PRIME}L)"
    return f"if({base_name} is null, null, xxhash64({index}, {base_name}) & {_MAX_LONG}L)"


def word_at(value: Column, index: int, mode: str = FAST) -> Column:
    """Word ``index`` of a value."""
    return word(base(value, mode), index, mode)


def word_array(value: Column, count: int, mode: str = FAST) -> Column:
    """The first ``count`` words of a value as one array."""
    if mode == PORTABLE:
        factors = F.array(*[F.lit(m).cast("bigint") for m in multipliers(count)])
        return let(base(value, mode), lambda b: F.transform(factors, lambda m: b * m % F.lit(PRIME)))
    indexes = F.sequence(F.lit(0), F.lit(count - 1))
    return let(
        base(value, mode),
        lambda b: F.transform(indexes, lambda i: F.xxhash64(i, b).bitwiseAND(F.lit(_MAX_LONG))),
    )


def uniform(value: Column, mode: str = FAST) -> Column:
    """A number strictly between 0 and 1 derived from the value."""
    return (word_at(value, 0, mode) % F.lit(PRIME - 1) + F.lit(1)) / F.lit(float(PRIME))


def lowest_bit(word_col: Column) -> Column:
    """The lowest set bit of a word; the word 0 counts as 2^32 (32 trailing zeros)."""
    return F.when(word_col == 0, F.lit(_ZERO_WORD_BIT)).otherwise(word_col.bitwiseAND(-word_col))


def bit_index(single_bit: Column) -> Column:
    """Position of the only set bit."""
    return F.bit_count(single_bit - F.lit(1))


def trailing_zeros(word_col: Column) -> Column:
    return bit_index(lowest_bit(word_col))
