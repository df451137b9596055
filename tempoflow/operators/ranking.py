"""Positions, last-N selections and last-N frames that never put one hot key or the whole table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoflow.session import checkpointed

_LOCAL_BITS = 33  # Fixed value: monotonically_increasing_id keeps the row offset in its low 33 bits.
BLOCK_ROWS = 1 << 18
SHARES = 64


def global_rank(df: DataFrame, order: list[str], partitions: int | None = None, rank: str = "position") -> DataFrame:
    """Add the 1-based position of each row in the total order of ``order``.

    Range-partition and sort, number the rows inside their partition, and add the size of the partitions before it.
    The sorted rows are checkpointed, so both passes see the same partitions even if executors are lost. The offset
    table has one row per partition. Include a unique column in ``order``: equal keys then spread over partitions.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    local = F.col("_local")
    numbered = checkpointed(
        ranged.sortWithinPartitions(*order).withColumn("_local", F.monotonically_increasing_id())
    )
    part = F.shiftright(local, _LOCAL_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    offset_in_part = local.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + offset_in_part + 1)
        .drop("_part", "_local", "_before")
    )


def chunk_number(rank: Column, size: int) -> Column:
    """0-based number of the run of ``size`` consecutive positions."""
    return F.floor((rank - 1) / F.lit(size)).cast("bigint")


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key in ``order``, numbered from 1.

    Two steps: each task's rows of a key go to one of a fixed number of shares and are cut to n there, then the shares
    meet. Up to the session's group-limit threshold Spark also keeps only n rows per key and task before each shuffle. So
    no task sees more of one key than the shares times n, however many tasks have read it.
    """
    columns = df.columns
    local = Window.partitionBy(*keys, "_share").orderBy(*order)
    df = (
        df.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(SHARES)))
        .withColumn("_local", F.row_number().over(local))
        .where(F.col("_local") <= n)
        .select(*columns)
    )
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def last_n(df: DataFrame, keys: list[str], order: list[str], n: int, age: str = "age") -> DataFrame:
    """The newest ``n`` rows per key with their age (1 = newest)."""
    return first_n(df, keys, [F.desc(c) for c in order], n, age)


def last_n_overall(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows of the whole table."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def trailing_sums(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bits: dict[str, Column],
    n: int,
    keep: list[str] | None = None,
    block_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """For every row: its arrival number in its key, and per signal the ones so far and the ones in the last n arrivals.

    Rows are laid out in one global order by key and arrival and cut into equal blocks; each block also receives the
    n - 1 rows before it. A frame of n rows then never leaves its block, so a key of any size is spread over many
    tasks. Totals before the block come from one small row per block and key. Rows without a key are rejected.
    """
    if block_rows is None:
        block_rows = max(BLOCK_ROWS, 64 * n)
    keep = list(dict.fromkeys([*keys, *order, *(keep or [])]))
    names = list(bits)
    slim = df.dropna(subset=keys).select(*keep, *[bits[b].cast("bigint").alias(f"_bit_{b}") for b in names])
    ranked = global_rank(slim, [*keys, *order], partitions, "_rank")
    block = chunk_number(F.col("_rank"), block_rows)

    # A row close to the end of its block is also history for the following ones.
    last_block = chunk_number(F.col("_rank") + F.lit(n - 1), block_rows)
    spread = ranked.withColumn("_home", block).withColumn("_block", F.explode(F.sequence(block, last_block)))

    measures = {"rows": F.lit(1).cast("bigint"), **{b: F.col(f"_bit_{b}") for b in names}}
    home = F.col("_home") == F.col("_block")
    per_block = ranked.groupBy(*keys, block.alias("_block")).agg(
        *[F.sum(m).alias(f"_sum_{name}") for name, m in measures.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(
        *keys,
        "_block",
        *[F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_carry_{name}") for name in measures],
    )

    arrivals = Window.partitionBy(*keys, "_block").orderBy("_rank")
    so_far = arrivals.rowsBetween(Window.unboundedPreceding, 0)
    frame = arrivals.rowsBetween(-(n - 1), 0)
    own = {name: F.when(home, m).otherwise(F.lit(0)) for name, m in measures.items()}
    windowed = spread.select(
        *keep,
        "_block",
        home.alias("_is_home"),
        *[F.sum(m).over(so_far).alias(f"_run_{name}") for name, m in own.items()],
        *[F.sum(f"_bit_{b}").over(frame).alias(f"recent_{b}") for b in names],
    ).where("_is_home")
    joined = windowed.join(carried, [*keys, "_block"])
    return joined.select(
        *keep,
        (F.col("_run_rows") + F.col("_carry_rows")).alias("arrival"),
        *[(F.col(f"_run_{b}") + F.col(f"_carry_{b}")).alias(f"total_{b}") for b in names],
        *[F.col(f"recent_{b}") for b in names],
    )
