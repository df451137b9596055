"""Periodic runs of words: candidates on a harmonic grid, extended exactly on a run-length grammar."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.recompression import Grammar

# A run is a stretch of at least LEAST words and POWER times its smallest period that cannot be made longer.
LEAST = 6
POWER = 4

GROUP_WORDS = 1 << 20
GROUP_BYTES = 1 << 24
SLICE = 1 << 18
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
SCHEMA = f"doc_id long, n_words long, runs {RUNS}, collapsed string"


def _grid(words: np.ndarray, least: int, power: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) at which the word one period on is the same, for periods of a doubling range at a time.

    In a run of period q and length l the words at l - q places in a row agree with those q on. That is at least
    max(least, power * q) - q places, so a grid of that step meets every run; over all periods it is harmonic and has about
    n ln n / (power - 1) points. At a place that belongs to so long a stretch the next two agree as well, or the last two.
    """
    begin = 1
    while begin <= longest:
        places, periods = [], []
        for q in range(begin, min(2 * begin, longest + 1)):
            step = max(least, power * q) - q
            found = np.flatnonzero(words[: len(words) - q : step] == words[q::step]) * step
            places.append(found)
            periods.append(np.full(len(found), q))
        i, q = np.concatenate(places), np.concatenate(periods)
        same = lambda k: words[np.clip(i + k, 0, len(words) - 1)] == words[np.clip(i + q + k, 0, len(words) - 1)]  # noqa: B023, E731
        kept = same(1) & same(2) | same(-1) & same(-2) if least >= 6 and power >= 4 else np.ones(len(i), bool)
        if kept.any():
            yield i[kept], q[kept]
        begin *= 2


def _runs(words: np.ndarray, grammar: Grammar, candidates: Iterator, least: int, power: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a sequence in which every text stands between words that occur once.

    A stretch with several periods is kept for the smallest: so long a one has only multiples of it besides, which come
    in later ranges. A place inside a known run whose period divides the candidate's needs no extension: it would give that run.
    """
    inside, until = np.zeros(len(words), np.int32), np.zeros(len(words), np.int32)
    found = [np.empty((0, 3), np.int64)]
    for places, periods in candidates:
        fresh = (inside[places] == 0) | (periods % np.maximum(inside[places], 1) > 0) | (places + periods >= until[places])
        places, periods, new = places[fresh], periods[fresh], []
        for k in range(0, len(places), SLICE):
            i, q = places[k : k + SLICE], periods[k : k + SLICE]
            ahead, behind = grammar.extensions(i, i + q), grammar.extensions(i, i + q, back=True)
            start, end = i - behind + 1, i + ahead + q
            long = end - start >= np.maximum(least, power * q)
            new.append(np.unique(np.stack((start, end, q), 1)[long], axis=0))
        for start, end, q in (new := np.unique(np.concatenate(new), axis=0) if new else found[0]):
            inside[start:end], until[start:end] = q, end
        found.append(new)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    return runs[:, 0], runs[:, 1], runs[:, 2]


class Texts:
    """Some texts side by side. The grid compares hashes of words, the grammar is made of exact numbers of words."""

    def __init__(self, least: int, power: int):
        self.least, self.power = least, power
        self.words: list[list[bytes]] = []
        self.parts: list[np.ndarray] = []
        self.size = self.bytes = 0

    def add(self, text: str | None) -> None:
        words = (text or "").encode("utf-8", "surrogatepass").split()  # at bytes 0x20 and 0x09 to 0x0D
        self.words.append(words)
        self.parts.append(np.fromiter(map(hash, words), np.int64, len(words)))
        self.size += len(words)
        self.bytes += len(text or "")

    def _sequence(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The parts with a separator before each and one at the end, and where each begins."""
        begins = np.cumsum([1, *(len(p) + 1 for p in parts)])
        out = np.empty(begins[-1], np.int64)
        out[begins - 1] = -1 - np.arange(len(begins))
        for part, at in zip(parts, begins, strict=False):
            out[at : at + len(part)] = part
        return out, begins

    def _numbers(self, texts: np.ndarray) -> list[np.ndarray]:
        number = defaultdict(count().__next__).__getitem__
        return [np.fromiter(map(number, self.words[t]), np.int64, len(self.words[t])) for t in texts]

    def _found(self, texts: np.ndarray) -> dict[int, np.ndarray]:
        longest = max((len(self.parts[t]) for t in texts), default=0)
        if longest < self.least:
            return {}
        words, begins = self._sequence([self.parts[t] for t in texts])
        hits = list(_grid(words, self.least, self.power, longest // self.power))
        if not hits:
            return {}
        # texts without a candidate have no run and stay out of the grammar
        hit = np.unique(np.searchsorted(begins, np.concatenate([i for i, _ in hits]), "right") - 1)
        hit = hit[(hit >= 0) & (hit < len(texts))]
        slim, slim_begins = self._sequence(self._numbers(texts[hit]))
        owner = [np.searchsorted(begins, i, "right") - 1 for i, _ in hits]
        moved = np.zeros(len(begins) + 1, np.int64)
        moved[hit] = slim_begins[:-1] - begins[hit]
        # places by a chance likeness of hashes, or across the end of a text, fall out by their extensions
        inner = [(o >= 0) & (i + q < begins[np.minimum(o + 1, len(begins) - 1)] - 1) for (i, q), o in zip(hits, owner, strict=True)]
        candidates = (((i + moved[o])[k], q[k]) for (i, q), o, k in zip(hits, owner, inner, strict=True))
        start, end, period = _runs(slim, Grammar(slim), candidates, self.least, self.power)
        owner = np.searchsorted(slim_begins, start, "right") - 1
        rows = np.stack((start - slim_begins[owner], end - start, period), 1)
        cuts = np.searchsorted(owner, np.arange(len(hit) + 1))
        return {int(texts[h]): rows[a:b] for h, a, b in zip(hit, cuts, cuts[1:], strict=False) if a < b}

    def results(self) -> Iterator[tuple[int, np.ndarray | None, bytes]]:
        """(number of words, runs by start and period, the text with one period left of each run) of the texts in order."""
        sizes = np.array([len(p) for p in self.parts])
        order = np.argsort(sizes, kind="stable")
        found: dict[int, np.ndarray] = {}
        # texts of like lengths are looked at together: the longest of them decides how many periods are tried
        cuts = np.flatnonzero(np.diff(np.floor(np.log2(np.maximum(sizes[order], 1))))) + 1
        for texts in np.split(order, cuts):
            found |= self._found(texts)
        for k, words in enumerate(self.words):
            runs = found.get(k)
            if runs is not None:
                runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, runs[:, 0] + runs[:, 2], 1)
                np.add.at(change, runs[:, 0] + runs[:, 1], -1)
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                yield len(words), runs, b" ".join(map(words.__getitem__, kept))
            else:
                yield len(words), None, b" ".join(words)


def _batch(ids: list, results: list[tuple[int, np.ndarray | None, bytes]]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *(0 if r is None else len(r) for _, r, _ in results)]).astype(np.int32)
    flat = np.concatenate([np.empty((0, 3), np.int64), *(r for _, r, _ in results if r is not None)])
    runs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], names=["start", "length", "period"])
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([n for n, _, _ in results], pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets), runs),
        pa.array([c for _, _, c in results], pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, row_id: str = "doc_id", text: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every whole text.

    Words are what stands between bytes 0x20 and 0x09 to 0x0D, numbered from 0. A run is a stretch whose words equal those one
    smallest period on, of at least ``least`` words and ``power`` periods (4 or more), that cannot be made longer. ``runs`` are in
    the order of start and period; ``collapsed`` has the words in no run behind its first period, joined by one space.

    Null and empty texts have no words and collapse to the empty text. Texts may be of any length: each is worked on by one task
    in memory of a fixed multiple of its size. Null ids are kept, repeated rows repeated, other columns ignored; an empty table gives
    no rows. Nothing is shuffled.
    """
    if power < 4 or least < 6:
        raise ValueError("runs of fewer than 6 words or 4 periods are not looked for")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = [], Texts(least, power)
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(row)
                texts.add(value.as_py())
                if texts.size >= GROUP_WORDS or texts.bytes >= GROUP_BYTES:
                    yield _batch(ids, list(texts.results()))
                    ids, texts = [], Texts(least, power)
        if ids:
            yield _batch(ids, list(texts.results()))

    return docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact quotient of length and period; of equal ones the first. Null without runs."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
