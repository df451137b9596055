"""State that Spark's own streaming aggregates do not keep: samples, exponential buckets, forget requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempoflow import schema as S
from tempoflow.functions.scalars import signal_bits
from tempoflow.operators import lastn, sampling, unlearning
from tempoflow.operators.ranking import last_n
from tempoflow.streaming.epochs import EpochTable, Handler

DGIM_STATE = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("signal", T.StringType()),
        T.StructField("arrivals", T.LongType()),
        T.StructField("ones", T.LongType()),
        T.StructField(
            "heads",
            T.ArrayType(T.StructType([T.StructField("age", T.LongType()), T.StructField("position", T.LongType())])),
        ),
    ]
)


def reservoir_handler(
    table: EpochTable, k: int = S.RESERVOIR_SIZE, key: Column | None = None, tie: tuple[str, ...] = ()
) -> Handler:
    """Keep a uniform sample of everything seen so far. The random key is stored with the row."""

    def handle(batch: DataFrame, epoch: int) -> None:
        keyed = sampling.keyed(batch, key)
        table.write(sampling.merge(table.before(batch.sparkSession, epoch), keyed, k, tie), epoch)

    return handle


def reservoir_schema(rows: T.StructType) -> T.StructType:
    return T.StructType([*rows.fields, T.StructField(sampling.KEY, T.StringType())])


def merge_dgim(
    state: DataFrame,
    batch: DataFrame,
    key: str = "artist",
    order: str = "seq",
    n: int = S.WINDOW_ARRIVALS,
    bits: dict[str, Column] | None = None,
) -> DataFrame:
    """Bucket state after one more batch, per key and signal.

    A bucket keeps the position of its newest one, its head. When ones arrive, the old heads grow older by their
    number, and those that still start a bucket of the new layout remain; so the state is O(log n) heads per key.
    From the batch only totals and the newest n rows per key are needed, both cut before the shuffle.
    """
    bits = bits or signal_bits()
    slim = batch.dropna(subset=[key]).select(
        F.col(key).alias("group"), order, *[c.cast("bigint").alias(f"_bit_{b}") for b, c in bits.items()]
    )
    totals = (
        slim.groupBy("group")
        .agg(F.count(F.lit(1)).alias("new_arrivals"), *[F.sum(f"_bit_{b}").alias(f"_ones_{b}") for b in bits])
        .select(
            "group",
            "new_arrivals",
            F.inline(F.array(*[F.struct(F.lit(b).alias("signal"), F.col(f"_ones_{b}").alias("new_ones")) for b in bits])),
        )
    )
    newest = last_n(slim, ["group"], [order], n).select(
        "group",
        "age",
        F.inline(F.array(*[F.struct(F.lit(b).alias("signal"), F.col(f"_bit_{b}").alias("bit")) for b in bits])),
    )
    one_age = F.row_number().over(Window.partitionBy("group", "signal").orderBy("age")).cast("bigint")
    fresh = (
        newest.where(F.col("bit") == 1)
        .select("group", "signal", F.col("age").cast("bigint").alias("row_age"), one_age.alias("one_age"))
        .groupBy("group", "signal")
        .agg(F.collect_list(F.struct("one_age", "row_age")).alias("fresh"))
    )
    merged = (
        state.join(totals, ["group", "signal"], "full_outer")
        .join(fresh, ["group", "signal"], "left")
        .select(
            "group",
            "signal",
            (F.coalesce("arrivals", F.lit(0)) + F.coalesce("new_arrivals", F.lit(0))).alias("arrivals"),
            (F.coalesce("ones", F.lit(0)) + F.coalesce("new_ones", F.lit(0))).alias("ones"),
            F.coalesce("new_ones", F.lit(0)).alias("shift"),
            F.coalesce("heads", F.array().cast(DGIM_STATE["heads"].dataType)).alias("old"),
            F.coalesce("fresh", F.array().cast("array<struct<one_age:bigint,row_age:bigint>>")).alias("fresh"),
        )
    )
    old = F.transform("old", lambda h: F.struct((h["age"] + F.col("shift")).alias("age"), h["position"].alias("position")))
    new = F.transform(
        "fresh",
        lambda o: F.struct(o["one_age"].alias("age"), (F.col("arrivals") - o["row_age"] + 1).alias("position")),
    )
    live_heads = F.filter(
        F.concat(new, old),
        lambda h: lastn.is_bucket_head(h["age"], F.col("ones")) & (h["position"] > F.col("arrivals") - n),
    )
    return merged.select("group", "signal", "arrivals", "ones", F.array_sort(live_heads).alias("heads"))


def dgim_estimates(state: DataFrame) -> DataFrame:
    """Estimate per key and signal from the bucket state."""
    sizes = F.transform("heads", lambda h: lastn.bucket_size(h["age"], F.col("ones")))
    total = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, s: a + s)
    oldest = F.coalesce(F.try_element_at("sizes", F.lit(-1)), F.lit(0))
    return state.withColumn("sizes", sizes).select(
        "group",
        "signal",
        (total - oldest / F.lit(2.0)).alias("estimated_count"),
        F.col("arrivals").alias("current_position"),
        F.size("heads").cast("bigint").alias("bucket_count"),
    )


def dgim_handler(table: EpochTable, **options) -> Handler:
    def handle(batch: DataFrame, epoch: int) -> None:
        table.write(merge_dgim(table.before(batch.sparkSession, epoch), batch, **options), epoch)

    return handle


def unlearn_handler(table: EpochTable, requests: Callable[[], DataFrame], since_request: bool = False) -> Handler:
    """Process each batch under the requests known at that moment: the request table is read again every epoch."""

    def handle(batch: DataFrame, epoch: int) -> None:
        table.write(unlearning.unlearn(batch, requests(), since_request), epoch)

    return handle
