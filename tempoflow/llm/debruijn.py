"""Long repeats of words by De Bruijn compaction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.anchors import BASE, minimizers, stretches, sums, windowed
from tempoflow.llm.common import TEXT_KEY, back_to_rows, distinct_texts, staged
from tempoflow.llm.runlength import covered

WINDOW = 35
GRAM = 10
OTHER_BASE = 0xC2B2AE3D27D4EB4F
LONG_WORD = 64
SPACE = np.isin(np.arange(256), (32, *range(9, 14)))


def word_hashes(text: bytes, base: int = BASE) -> np.ndarray:
    """64 bits for each word between ASCII white space, others for another base.

    Short words are hashed together by a polynomial modulo 2^64. Under any such polynomial long sequences of few values can meet by
    design, so words above :data:`LONG_WORD` bytes are hashed one by one by XXH3-128, of which each base has its half.
    """
    line = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([False], ~SPACE[line], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    out = stretches(sums(line.astype(np.uint64) + np.uint64(1), base), starts, ends, base)
    half = 0 if base == BASE else 64
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        out[i] = (xxhash.xxh3_128_intdigest(text[starts[i] : ends[i]]) >> half) & ((1 << 64) - 1)
    return out


class Path:
    """One text as a path of the graph: anchored k-mers are its nodes, the stretches of words between them its edges.

    An edge runs from the start of one anchor to the end of the next; the first and last edges end with the text and say so,
    hence a text's end counts as a branch of its own.
    """

    def __init__(self, text: bytes, window: int, gram: int):
        words = word_hashes(text)
        self.size = len(words)
        self.running = sums(words)
        hashes = windowed(self.running, gram)
        self.place, self.first, self.last = minimizers(hashes, window - gram + 1)
        self.node = hashes[self.place].view(np.int64)
        self.low = np.append(0, self.place[:-1]) if len(self.place) else self.place
        self.high = np.append(self.place[1:] + gram, self.size) if len(self.place) else self.place

    def edges(self, gram: int) -> tuple[np.ndarray, np.ndarray]:
        into = stretches(self.running, self.low, self.place + gram)
        out = stretches(self.running, self.place, self.high)
        if len(into):
            into[0] ^= np.uint64(0xA5A5A5A5)
            out[-1] ^= np.uint64(0x5A5A5A5A)
        return into.view(np.int64), out.view(np.int64)


def _encoded(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield value.as_py().encode("utf-8", "surrogatepass")


def nodes(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``t1, t2, copies, node, place, into, out``: nodes of each text with the edges on both sides."""
    names = ["t1", "t2", "copies", "node", "place", "into", "out"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                paths = [Path(text, window, gram) for text in _encoded(part.column(3))]
                counts = [len(p.node) for p in paths]
                both = [p.edges(gram) for p in paths]
                columns = [np.repeat(part.column(c).to_numpy(), counts) for c in range(3)]
                columns += [np.concatenate(x) for x in ([p.node for p in paths], [p.place for p in paths], [b[0] for b in both], [b[1] for b in both])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return texts.select(*TEXT_KEY, "copies", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def shared_nodes(places: DataFrame) -> DataFrame:
    """``node, straight``: nodes at two or more places; straight ones have one edge on either side in all of them."""
    sides = [f(c).alias(f"{f.__name__}_{c}") for c in ("into", "out") for f in (F.min, F.max)]
    stats = places.groupBy("node").agg(F.sum("copies").alias("n"), *sides)
    straight = (F.col("min_into") == F.col("max_into")) & (F.col("min_out") == F.col("max_out"))
    # moved by a hash, so that adaptive execution may split a hot node in the join with its places
    return stats.where("n > 1").select("node", straight.alias("straight")).repartition(F.xxhash64("node"))


SPANS = "t1 long, t2 long, copies long, first long, last long, h1 long, h2 long"


def spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Ranges of window starts that compacted paths settle (``h1`` null), and single windows left to be verified.

    Joined with the counts of the graph, the straight nodes that follow one another in a text are a nonbranching path: wherever
    one of them stands, the whole path stands, with both its end edges. A window on the path that belongs to one of its nodes is
    therefore repeated as often as the node, and needs no look at any text. Windows that reach over a branching node are
    given with 128 bits of their words and their coordinates; windows of nodes that stand once are unique.
    """
    places = nodes(texts, window, gram)
    joined = places.select(*TEXT_KEY, "node", "place").join(shared_nodes(places), "node")
    per_text = joined.groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("place", "straight")).alias("own"))
    rows = texts.join(per_text, list(TEXT_KEY)).select(*TEXT_KEY, "copies", "text", "own")

    def settle(text: bytes, own) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        path = Path(text, window, gram)
        kind = np.zeros(len(path.node), np.int8)
        at = np.searchsorted(path.place, own.field(0).to_numpy())
        kind[at] = 1 + own.field(1).to_numpy(zero_copy_only=False)
        ranges, open_windows = [], np.zeros(max(0, path.size - window + 1), bool)
        for i in np.flatnonzero(kind == 1).tolist():
            open_windows[path.first[i] : path.last[i] + 1] = True
        new = np.flatnonzero(np.diff(np.concatenate(([0], (kind == 2).astype(np.int8), [0]))))
        for a, b in zip(new[::2].tolist(), new[1::2].tolist(), strict=True):
            first, last = int(path.first[a]), int(path.last[b - 1])
            low, high = max(first, int(path.low[a])), min(last, int(path.high[b - 1]) - window)
            open_windows[first : last + 1] = True
            if low <= high:
                open_windows[low : high + 1] = False
                ranges.append((low, high))
        starts = np.flatnonzero(open_windows)
        one = windowed(path.running, window)[starts].view(np.int64)
        two = windowed(sums(word_hashes(text, OTHER_BASE), OTHER_BASE), window, OTHER_BASE)[starts].view(np.int64)
        return ranges, starts, one, two

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SPANS.split(", ")]
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                keys = [part.column(c).to_numpy() for c in range(3)]
                owner, first, last, one, two, blank = [], [], [], [], [], []
                for i, (text, own) in enumerate(zip(_encoded(part.column(3)), part.column(4), strict=True)):
                    ranges, starts, h1, h2 = settle(text, own.values)
                    owner.append(np.full(len(ranges) + len(starts), i))
                    first.append(np.append([r[0] for r in ranges], starts))
                    last.append(np.append([r[1] for r in ranges], starts))
                    pad = np.zeros(len(ranges), np.int64)
                    one.append(np.append(pad, h1))
                    two.append(np.append(pad, h2))
                    blank.append(np.append(np.ones(len(ranges), bool), np.zeros(len(starts), bool)))
                owner, blank = np.concatenate(owner), np.concatenate(blank)
                columns = [pa.array(k[owner], pa.int64()) for k in keys]
                columns += [pa.array(np.concatenate(x).astype(np.int64)) for x in (first, last)]
                columns += [pa.array(np.concatenate(x).astype(np.int64), mask=blank) for x in (one, two)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, SPANS)


def repeated(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``t1, t2, first, last``: ranges of starts of windows whose words also stand anywhere else."""
    found = staged(spans(texts, window, gram), "spans")
    unsure = found.where("h1 is not null")
    twice = unsure.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).where("n > 1").select("h1", "h2").repartition(F.xxhash64("h1", "h2"))
    verified = unsure.join(twice, ["h1", "h2"], "left_semi")
    return found.where("h1 is null").union(verified.select(found.columns)).select(*TEXT_KEY, "first", "last")


def kept_words(texts: DataFrame, marks: DataFrame, window: int = WINDOW) -> DataFrame:
    """``t1, t2, n_words, n_removed, kept_sha256, kept`` of each different text; ``kept`` is null where nothing went."""
    per_text = marks.groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("first", "last")).alias("marks"))
    names = ["t1", "t2", "n_words", "n_removed", "kept_sha256", "kept"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                rows = []
                for t1, t2, text, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _encoded(part.column(2)), part.column(3), strict=True):
                    words = text.split()
                    kept, removed = words, 0
                    if own.is_valid:
                        begins, ends = covered(own.values.field(0).to_numpy(), own.values.field(1).to_numpy(), window, len(words))
                        removed = int((ends - begins).sum())
                        kept = []
                        for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(words)], strict=True):
                            kept += words[a:b]
                    line = b" ".join(kept)
                    rows.append((t1, t2, len(words), removed, hashlib.sha256(line).hexdigest(), line.decode("utf-8", "surrogatepass") if removed else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "t1 long, t2 long, n_words long, n_removed long, kept_sha256 string, kept string"
    return texts.join(per_text, list(TEXT_KEY), "left").select(*TEXT_KEY, "text", "marks").mapInArrow(run, schema)


EMPTY = {"n_words": 0, "n_removed": 0, "kept_sha256": hashlib.sha256(b"").hexdigest()}


def remove_repeats(docs: DataFrame, row_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``: what is left of each text without words that a repeated window covers.

    Words stand between ASCII white space and are taken as they are; a window of ``window`` words counts as repeated if its
    words also start anywhere else, in the same text or another one. Null and empty texts have no words, rows with equal
    texts cover each other if long enough, null ids are kept, other columns are ignored, an empty table gives no rows.
    """
    texts = distinct_texts(docs, text)
    return back_to_rows(docs, kept_words(texts, repeated(texts, window, gram), window).drop("kept"), EMPTY, row_id, text)
