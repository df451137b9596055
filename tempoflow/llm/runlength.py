"""Long repeats of bytes by a run-compressed Burrows-Wheeler transform."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.anchors import minimizers, stretches, sums, windowed
from tempoflow.llm.common import TEXT_KEY, back_to_rows, distinct_texts, staged, text_key

LENGTH = 200
GRAM = 40
UNIT_BYTES = 1 << 20
LEVELS = (None, 8, 1)


# ---- the index of one unit of pieces


def suffix_array(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Places of ``symbols`` in the order of the suffixes; every suffix is told apart within ``longest`` symbols.

    Prefix doubling: groups of suffixes with equal prefixes are sorted by the rank of what follows, until none is left.
    """
    n = len(symbols)
    padded = np.concatenate((symbols, np.zeros(4, np.int64)))
    width = max(2, int(symbols.max()).bit_length()) if n else 2
    depth = max(1, min(4, 62 // width))
    key = np.zeros(n, np.int64)
    for d in range(depth):
        key = key << width | padded[d : d + n]
    order = np.argsort(key)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1

    def regroup(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rank of each group of equal keys is its first slot; returns which slots are still in groups of several."""
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        starts = np.flatnonzero(new)
        rank[order[slots]] = np.repeat(slots[starts], np.diff(np.append(starts, len(slots))))
        alone = new & np.append(new[1:], True)
        return slots[~alone]

    slots = regroup(np.arange(n), key[order]) if n else np.empty(0, np.int64)
    while len(slots) and depth < 2 * longest:
        places = order[slots]
        keys = rank[places] * (n + 1) + rank[np.minimum(places + depth, n)] + 1
        by = np.argsort(keys)
        order[slots] = places[by]
        slots = regroup(slots, keys[by])
        depth *= 2
    return order


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length to which the suffixes at ``a`` and ``b`` agree, up to ``most``; sixteen symbols of a slice of pairs at a time."""
    padded = np.concatenate((text, -1 - np.arange(16)))
    out = np.zeros(len(a), np.int64)
    step = np.arange(16)
    for k in range(0, len(a), 1 << 15):
        live = np.arange(k, min(len(a), k + (1 << 15)))
        while len(live) and out[live[0]] < most:
            x, y = a[live] + out[live], b[live] + out[live]
            fits = (x < len(text)) & (y < len(text))
            same = padded[np.minimum(x, len(text))[:, None] + step] == padded[np.minimum(y, len(text))[:, None] + step]
            same[~fits] = False
            run = np.where(same.all(axis=1), 16, same.argmin(axis=1))
            out[live] += run
            live = live[run == 16]
    return out


def matching_statistics(pieces: list[bytes]) -> np.ndarray:
    """For each byte of the joined pieces (a separator after each), how far it goes on like it does at some other place.

    The Burrows-Wheeler transform of the pieces is cut into its runs. Only at the ends of runs are suffixes compared
    with their neighbours in sorted order; these are the samples. Inside a run, the neighbour of the suffix one to the
    left is the neighbour's left one, so its value is one more: streaming the text from left to right, a value that is not
    sampled is the one before, less one. Separators are symbols of their own, so no match runs across pieces.
    """
    size = np.array([len(p) for p in pieces])
    ends = np.cumsum(size + 1) - 1
    symbols = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + len(pieces) + 1
    symbols[ends] = np.arange(1, len(pieces) + 1)
    order = suffix_array(symbols, int(size.max()) + 1)
    before = np.where(order > 0, symbols[order - 1], 0)
    change = before[1:] != before[:-1]
    heads = np.flatnonzero(change) + 1  # first slots of runs; the slots before are the last of theirs
    agree = common_prefix(symbols, order[heads], order[heads - 1], int(size.max()) + 1)
    n = len(symbols)

    def streamed(places: np.ndarray, values: np.ndarray) -> np.ndarray:
        sampled = np.zeros(n, bool)
        value = np.zeros(n, np.int64)
        sampled[places], value[places] = True, values
        last = np.maximum.accumulate(np.where(sampled, np.arange(n), -1))
        return np.where(last < 0, 0, np.maximum(0, value[last] - (np.arange(n) - last)))

    with_smaller = streamed(np.append(order[heads], order[0]), np.append(agree, 0))
    with_larger = streamed(np.append(order[heads - 1], order[-1]), np.append(agree, 0))
    return np.maximum(with_smaller, with_larger)


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def repeated_windows(pieces: list[bytes], copies: list[int], length: int = LENGTH) -> list[list[dict]]:
    """Of each piece, the ranges of starts of stretches of ``length`` that stand anywhere else, in the piece itself included.

    A piece that stands for several places repeats from end to end, and an index of it alone has nothing to tell.
    """
    found = matching_statistics(pieces) >= length if len(pieces) > 1 or len(pieces[0]) > length else np.zeros(len(pieces[0]) + 1, bool)
    out, at = [], 0
    for piece, n in zip(pieces, copies, strict=True):
        flags = found[at : at + len(piece)]
        if n > 1:
            flags = np.arange(len(piece)) <= len(piece) - length
        out.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(*_ranges(flags), strict=True)])
        at += len(piece) + 1
    return out


# ---- anchors and pieces of texts


def _anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Key, place, first and last window of each anchor."""
    values = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    hashes = windowed(sums(values), gram)
    place, first, last = minimizers(hashes, length - gram + 1)
    return hashes[place].view(np.int64), place, first, last


def _merged(key: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring anchors of one key as one: a text with a short period has a single anchor instead of one per byte."""
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    return key[new], first[new], np.append(last[new[1:] - 1], last[-1:]), np.diff(np.append(new, len(key)))


def _encoded(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield value.as_py().encode("utf-8", "surrogatepass")


def anchor_rows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``t1, t2, places, key, first``: merged anchors of each text with the number of places of the corpus that each stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                keys, firsts, places, counts = [], [], [], []
                for copies, text in zip(part.column(2).to_pylist(), _encoded(part.column(3)), strict=True):
                    key, _, first, last = _anchors(text, length, gram)
                    key, first, _, merged = _merged(key, first, last)
                    keys.append(key)
                    places.append(merged * copies)
                    firsts.append(first)
                    counts.append(len(key))
                source = [np.repeat(part.column(c).to_numpy(), counts) for c in range(2)]
                columns = [*source, np.concatenate(places), np.concatenate(keys), np.concatenate(firsts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["t1", "t2", "places", "key", "first"])

    return texts.select(*TEXT_KEY, "copies", "text").mapInArrow(run, "t1 long, t2 long, places long, key long, first long")


PIECES = "t1 long, t2 long, head long, first long, key long, copies long, piece binary"


def pieces(texts: DataFrame, chosen: DataFrame, block: int | None, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The stretch of text that holds all windows of each anchor in ``chosen`` (``t1, t2, key, first``).

    Two pieces of a text overlap by less than ``length``, so a window lies in one piece only and never meets itself. With
    ``block``, an anchor's windows are dealt by their distance from it into blocks, keyed by a hash of the bytes that all windows of
    a block share: equal windows meet again, and what only shares the anchor parts.
    """
    per_text = chosen.groupBy(*TEXT_KEY).agg(F.collect_list("first").alias("firsts"))
    rows = texts.join(per_text, list(TEXT_KEY)).select(*TEXT_KEY, "copies", "text", "firsts")

    def cut(text: bytes, wanted: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        key, place, first, last = _anchors(text, length, gram)
        whole, heads, tails, _ = _merged(key, first, last)
        use = np.isin(heads, wanted)
        if block is None:
            for k, a, b in zip(whole[use].tolist(), heads[use].tolist(), tails[use].tolist(), strict=True):
                yield a, a, k, text[a : b + length]
            return
        running = sums(np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1))
        run = np.searchsorted(heads, first, side="right") - 1
        for i in np.flatnonzero(use[run]).tolist():
            p = int(place[i])
            for b in range((p - int(last[i])) // block, (p - int(first[i])) // block + 1):
                low, high = max(int(first[i]), p - block * b - block + 1), min(int(last[i]), p - block * b)
                core = np.array([p - block * b]), np.array([min(p - block * b - block + 1 + length, len(text))])
                yield int(heads[run[i]]), low, int(stretches(running, *core)[0].view(np.int64)) ^ (b << 48), text[low : high + length]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.binary()]
        names = [part.split()[0] for part in PIECES.split(", ")]
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                out = []
                source = zip(*(part.column(c).to_pylist() for c in (0, 1, 2)), _encoded(part.column(3)), part.column(4), strict=True)
                for t1, t2, copies, text, firsts in source:
                    out += [(t1, t2, h, a, k, copies, piece) for h, a, k, piece in cut(text, firsts.values.to_numpy())]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return rows.mapInArrow(run, PIECES)


MARKS = "p1 long, p2 long, marks array<struct<first:int,last:int>>"
MARK_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def indexed(distinct: DataFrame, length: int = LENGTH, unit: int = UNIT_BYTES) -> DataFrame:
    """Marks of each different piece: all pieces of a key meet in one index, of about ``unit`` bytes and several keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def solve() -> pa.RecordBatch:
            marks = repeated_windows([h[4] for h in held], [h[3] for h in held], length)
            rows = [(h[1], h[2], m) for h, m in zip(held, marks, strict=True) if m]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.int64(), pa.int64(), MARK_TYPE)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["p1", "p2", "marks"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= unit and row[0] != held[-1][0]:
                    yield solve()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield solve()

    dealt = distinct.repartition("key").sortWithinPartitions("key", "p1", "p2").select("key", "p1", "p2", "n", "piece")
    return dealt.mapInArrow(run, MARKS)


def repeated(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, unit: int = UNIT_BYTES) -> DataFrame:
    """``t1, t2, first, last``: ranges of starts of stretches of ``length`` bytes that stand anywhere else.

    Equal pieces are one row with a count before they reach an index. A key with more than four units of different pieces is cut
    finer (:func:`pieces`); at the finest level equal keys have equal pieces, so every index is bounded and none is skipped.
    """
    anchors = anchor_rows(texts, length, gram)
    shared = anchors.groupBy("key").agg(F.sum("places").alias("n")).where("n > 1").select("key")
    shared = shared.repartition(F.xxhash64("key"))  # moved by a hash, so that adaptive execution may split a hot anchor
    chosen = anchors.join(shared, "key", "left_semi").select(*TEXT_KEY, "first")
    ids = [F.xxhash64("key", "piece").alias("p1"), F.xxhash64(F.lit(11), F.col("piece"), F.col("key")).alias("p2")]
    out = None
    for level, block in enumerate(LEVELS):
        cut = staged(pieces(texts, chosen, block, length, gram).select("*", *ids), "pieces")
        distinct = cut.groupBy("key", "p1", "p2").agg(F.first("piece").alias("piece"), F.sum("copies").alias("n"))
        crowded = None
        if level < len(LEVELS) - 1:
            sizes = cut.select("key", "p1", "p2", F.length("piece").alias("size")).distinct()
            weight = sizes.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("kinds"))
            crowded = staged(weight.where((F.col("size") > 4 * unit) & (F.col("kinds") > 1)).select("key"), "crowded")
            if crowded.isEmpty():
                crowded = None
            else:
                distinct = distinct.join(crowded, "key", "left_anti")
        marks = indexed(distinct, length, unit).repartition(F.xxhash64("p1", "p2"))
        placed = cut.select("p1", "p2", *TEXT_KEY, F.col("first").alias("at")).join(marks, ["p1", "p2"])
        placed = placed.select(*TEXT_KEY, "at", F.explode("marks").alias("m"))
        placed = placed.select(*TEXT_KEY, (F.col("at") + F.col("m.first")).alias("first"), (F.col("at") + F.col("m.last")).alias("last"))
        out = placed if out is None else out.union(placed)
        if crowded is None:
            return out
        chosen = cut.join(crowded, "key", "left_semi").select(*TEXT_KEY, F.col("head").alias("first")).distinct()
    return out


# ---- removal


def covered(firsts: np.ndarray, lasts: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches that windows of ``length`` starting in the given ranges cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, lasts + length, -1)
    return _ranges(np.cumsum(change[:-1]) > 0)


def kept_texts(texts: DataFrame, marks: DataFrame, length: int = LENGTH) -> DataFrame:
    """``t1, t2, n_bytes, n_removed, n_spans, kept_sha256, spans, kept`` of each different text; ``kept`` is null unless bytes went.

    Where a removed stretch begins or ends inside a character, ``kept`` leaves the rest of that character out; the digest is
    that of the bytes themselves.
    """
    per_text = marks.groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("first", "last")).alias("marks"))
    schema = (
        "t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,end:long>>, kept string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64()] * 5 + [pa.string(), spans_type, pa.string()]
        names = ["t1", "t2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                rows = []
                for t1, t2, text, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _encoded(part.column(2)), part.column(3), strict=True):
                    if not own.is_valid:
                        rows.append((t1, t2, len(text), 0, 0, hashlib.sha256(text).hexdigest(), [], None))
                        continue
                    fields = own.values
                    begins, stops = covered(fields.field(0).to_numpy(), fields.field(1).to_numpy(), length, len(text))
                    keep = b"".join(text[a:b] for a, b in zip([0, *stops.tolist()], [*begins.tolist(), len(text)], strict=True))
                    spans = [{"start": a, "end": b} for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
                    gone = len(text) - len(keep)
                    rows.append((t1, t2, len(text), gone, len(spans), hashlib.sha256(keep).hexdigest(), spans, keep.decode("utf-8", "ignore")))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return texts.join(per_text, list(TEXT_KEY), "left").select(*TEXT_KEY, "text", "marks").mapInArrow(run, schema)


EMPTY = {"n_bytes": 0, "n_removed": 0, "n_spans": 0, "kept_sha256": hashlib.sha256(b"").hexdigest()}


def remove_repeats(docs: DataFrame, row_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, unit: int = UNIT_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``: what is left of each text without bytes that a repeated stretch covers.

    A stretch of ``length`` bytes counts as repeated if it also starts anywhere else, in the same text or another one. Null and
    empty texts have no bytes (the digest is that of nothing), rows with equal texts cover each other if long enough, null
    ids are kept, other columns are ignored, an empty table gives no rows. Texts of any length are read whole.
    """
    texts = distinct_texts(docs, text)
    results = kept_texts(texts, repeated(texts, length, gram, unit), length).drop("spans", "kept")
    return back_to_rows(docs, results, EMPTY, row_id, text)


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Rows of ``docs`` with the repeated stretches cut out of their texts; every row stays, and other columns as they are."""
    texts = distinct_texts(docs, text)
    changed = kept_texts(texts, repeated(texts, length), length).where("n_removed > 0").select(*TEXT_KEY, F.col("kept").alias("kept_text"))
    joined = docs.select(F.struct(*docs.columns).alias("row"), *text_key(text)).join(changed.repartition(F.xxhash64(*TEXT_KEY)), list(TEXT_KEY), "left")
    return joined.select(*[F.coalesce("kept_text", "row." + c).alias(c) if c == text else F.col("row." + c) for c in docs.columns])
