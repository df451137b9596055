"""State kept per key in Spark's state store, and results of changed keys upserted into a store."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tempoflow import schema as S
from tempoflow.functions.scalars import signal_bits
from tempoflow.sources.store import Generations, Store, Version, newest
from tempoflow.streaming.epochs import Handler

VACUUM_EVERY = 64


def upsert_handler(table: Generations, vacuum_every: int = VACUUM_EVERY) -> Handler:
    """Write the rows of each epoch as a generation of its own; of rows with equal keys the newest epoch counts.

    Only what an epoch brings is written, beside the merging of generations. A replayed epoch is found committed and skipped.
    """

    def handle(batch: DataFrame, epoch: int) -> None:
        table.add(batch.withColumn("epoch", F.lit(epoch).cast("bigint")), epoch)
        if vacuum_every and epoch % vacuum_every == vacuum_every - 1:
            table.store.vacuum(keep=2)

    return handle


def upserts(store: Store, table: str, keys: list[str]) -> Generations:
    return Generations(store, table, newest(keys))


# ---- exponential buckets ----------------------------------------------------------------------------------------

PARTIAL = "group string, arrivals long, ones array<long>, orders array<long>, masks array<long>"
STATE = "arrivals long, ones array<long>, ages array<array<long>>, positions array<array<long>>"
RESULT = "group string, signal string, arrivals long, ones long, heads array<struct<age:bigint,position:bigint>>, expired boolean"


def _level(age: int, ones: int) -> int:
    """Level of the bucket that holds the one of this age, by the rule of :mod:`tempoflow.operators.lastn`."""
    top = age.bit_length() - 1
    return top - 1 if top and age <= (1 << top) - 1 + (ones + 1) % (1 << top) else top


def _is_head(age: int, ones: int) -> bool:
    size = 1 << _level(age, ones)
    below = size - 1 + (ones + 1) % size if size > 1 else 0
    return (age - 1 - below) % size == 0


def _newest(orders: np.ndarray, masks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` newest arrivals, newest first."""
    if len(orders) > n:
        kept = np.argpartition(-orders, n - 1)[:n]
        orders, masks = orders[kept], masks[kept]
    at = np.argsort(-orders, kind="stable")
    return orders[at], masks[at]


def partials(stream: DataFrame, key: str, order: str, n: int, bits: dict[str, Column]) -> DataFrame:
    """Per task and key: the number of arrivals, the ones of each signal, and the ``n`` newest arrivals with their signals.

    So a key sends one row per task to its state, however many rows it has. A task holds at most the rows that it reads.
    """
    mask = sum((bits[b].cast("bigint") * (1 << k) for k, b in enumerate(bits)), F.lit(0).cast("bigint"))
    slim = stream.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("group"), F.col(order).cast("bigint").alias("at"), mask.alias("mask"))
    signals = np.arange(len(bits))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        for frame in frames:
            for group, rows in frame.groupby("group", sort=False):
                orders, masks = rows["at"].to_numpy(), rows["mask"].to_numpy()
                ones = (masks[:, None] >> signals & 1).sum(0)
                old = held.get(group)
                if old:
                    ones, orders, masks = old[1] + ones, np.concatenate((old[2], orders)), np.concatenate((old[3], masks))
                held[group] = [(old[0] if old else 0) + len(rows), ones, *_newest(orders, masks, n)]
        if held:
            yield pd.DataFrame([(g, *values) for g, values in held.items()], columns=["group", "arrivals", "ones", "orders", "masks"])

    return slim.mapInPandas(run, PARTIAL)


def dgim_states(
    stream: DataFrame,
    key: str = "artist",
    order: str = "seq",
    n: int = S.WINDOW_ARRIVALS,
    bits: dict[str, Column] | None = None,
    silence: float | None = None,
) -> DataFrame:
    """Bucket state of the keys that an epoch meets, one row per key and signal; for update mode.

    The state store holds per key the arrivals and per signal the ones and the O(log n) heads of buckets; keys that an epoch does not meet are
    not touched. With ``silence`` (seconds of processing time) a key that stays silent so long loses its state; its
    last rows are marked ``expired``, and it starts anew when it comes back.
    """
    bits = bits or signal_bits()
    names, timeout = list(bits), GroupStateTimeout.ProcessingTimeTimeout if silence else GroupStateTimeout.NoTimeout

    def result(group: str, arrivals: int, ones: list, ages: list, positions: list, expired: bool) -> pd.DataFrame:
        heads = [[{"age": int(a), "position": int(p)} for a, p in zip(*pair, strict=True)] for pair in zip(ages, positions, strict=True)]
        columns = {"group": group, "signal": names, "arrivals": arrivals, "ones": ones, "heads": heads, "expired": expired}
        return pd.DataFrame(columns)

    def merge(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            arrivals, ones, ages, positions = state.get
            state.remove()
            yield result(group[0], arrivals, ones, ages, positions, True)
            return
        empty = (0, [0] * len(names), [[] for _ in names], [[] for _ in names])
        arrivals, ones, ages, positions = state.get if state.exists else empty
        new_ones, orders, masks = np.zeros(len(names), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        for frame in frames:
            arrivals += int(frame["arrivals"].sum())
            for o, at, mask in zip(frame["ones"], frame["orders"], frame["masks"], strict=True):
                new_ones += np.asarray(o, np.int64)
                orders, masks = _newest(np.concatenate((orders, at)), np.concatenate((masks, mask)), n)
        total, all_ages, all_positions = [], [], []
        for k in range(len(names)):
            count = int(ones[k]) + int(new_ones[k])
            where = np.flatnonzero(masks >> k & 1)
            fresh = [(i + 1, arrivals - int(w)) for i, w in enumerate(where)]
            old = [(int(a) + int(new_ones[k]), int(p)) for a, p in zip(ages[k], positions[k], strict=True)]
            live = [(a, p) for a, p in fresh + old if p > arrivals - n and _is_head(a, count)]
            total.append(count)
            all_ages.append([a for a, _ in live])
            all_positions.append([p for _, p in live])
        state.update((arrivals, total, all_ages, all_positions))
        if silence:
            state.setTimeoutDuration(max(1, int(silence * 1000)))
        yield result(group[0], arrivals, total, all_ages, all_positions, False)

    merged = partials(stream, key, order, n, bits).groupBy("group")
    return merged.applyInPandasWithState(merge, RESULT, STATE, "update", timeout)


def live(table: Generations, version: Version | None = None) -> DataFrame:
    """The newest state of each key that has not expired, with heads newest first."""
    return table.read(version).where(~F.col("expired")).drop("expired", "epoch").withColumn("heads", F.array_sort("heads"))
