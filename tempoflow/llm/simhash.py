"""SimHash near-duplicates with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.common import staged
from tempoflow.llm.components import components
from tempoflow.session import broadcast_if_small

DISTANCE = 3
SEGMENTS = 4
BLOCK = 8192


def shingles(text: str | None, shingle: int, seed: int = 42) -> Iterator[np.ndarray]:
    """64-bit hashes of all word shingles, repeats included, in parts; none for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    pairs = list(zip(starts.tolist(), ends.tolist(), strict=True))
    for k in range(0, len(pairs), 50_000):
        part = pairs[k : k + 50_000]
        yield np.fromiter((digest(line[a:b], seed) for a, b in part), "<u8", len(part))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64 bits; bit i is set if it is set in more than half of the hashes of all word shingles."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingles(text, shingle, seed):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, row_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` with the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(v.as_py(), shingle) for v in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def ring_keys(prints: DataFrame) -> DataFrame:
    """``fp, key``: two fingerprints within the distance share a key.

    The four 16-bit segments form a ring. By the pigeonring principle there is a start i from which every chain of l
    segments differs in at most 3l/4 bits: none in segment i, at most one in i and i+1, at most two in three segments. So
    segment i agrees, and of the two halves of segment i+1 one agrees: the key is (i, which half, segment i, that half),
    24 bits of the fingerprint. :func:`_viable` tests the rest of the chain.
    """
    segment = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(SEGMENTS)]
    keys = []
    for i in range(SEGMENTS):
        for half in (0, 1):
            own = F.shiftrightunsigned(segment[(i + 1) % SEGMENTS], 8 * half).bitwiseAND(0xFF)
            keys.append(F.shiftleft(segment[i], 8) + own + F.lit((2 * i + half) << 24))
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def _links(left: np.ndarray, right: np.ndarray, start: int) -> np.ndarray:
    """Which pairs are linked, found from segment ``start``: chains within 0, 1, 2 and 3 differing bits, then the whole.

    The chain's length grows segment by segment and only pairs that are still viable are looked at again.
    """
    i, j = np.nonzero(((left[:, None] ^ right[None, :]) >> np.uint64(16 * start)) & np.uint64(0xFFFF) == 0)
    diff = left[i] ^ right[j]
    total = np.zeros(len(i), np.int64)
    for step in range(1, SEGMENTS):
        shift = np.uint64(16 * ((start + step) % SEGMENTS))
        total += np.bitwise_count((diff >> shift) & np.uint64(0xFFFF))
        ok = total <= DISTANCE * (step + 1) // SEGMENTS
        i, j, diff, total = i[ok], j[ok], diff[ok], total[ok]
    ok = np.bitwise_count(diff) <= DISTANCE
    return np.stack((i[ok], j[ok]))


def forest(left: np.ndarray, right: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links between two blocks as a spanning forest: fewer edges than rows, whatever the number of links."""
    values, at = np.unique(np.concatenate((left, right)), return_inverse=True)
    label = np.arange(len(values))
    place = at[len(left) :]
    edges = []
    width = max(1, 1_000_000 // max(1, len(right)))
    for k in range(0, len(left), width):
        i, j = _links(left[k : k + width], right, start)
        bounds = np.searchsorted(i, np.arange(min(width, len(left) - k) + 1))
        for row in np.unique(i):
            own = at[k + row]
            others = place[j[bounds[row] : bounds[row + 1]]]
            new, first = np.unique(label[others], return_index=True)
            for other in others[first[new != label[own]]]:
                edges.append((int(values[own].view(np.int64)), int(values[other].view(np.int64))))
            if len(new) > 1 or new[0] != label[own]:
                label[np.isin(label, new)] = label[own]
    return edges


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of sorted runs (key, r, c); only the run that a batch breaks off is carried over."""

    def solve(key: int, block: np.ndarray, fp: np.ndarray, edges: list) -> None:
        first = block == block[0]
        edges += forest(fp[first], fp if first.all() else fp[~first], int(key) >> 25)

    held = None
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in range(5)]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        key, r, c, block, fp = rows
        if not len(key):
            continue
        new = np.flatnonzero((np.diff(key) != 0) | (np.diff(r) != 0) | (np.diff(c) != 0)) + 1
        bounds = np.concatenate(([0], new))
        held, edges = [x[bounds[-1] :] for x in rows], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                solve(key[a], block[a:b], fp[a:b].view(np.uint64), edges)
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], names=["a", "b"])
    if held is not None and len(held[0]) > 1:
        solve(held[0][0], held[3], held[4].view(np.uint64), edges := [])
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], names=["a", "b"])


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect what lies within the distance, out of distinct fingerprints ``fp``.

    A bucket of more than ``block`` fingerprints is cut by a hash into blocks, and each pair of blocks is a unit of work of its
    own, so no task holds more than two blocks, and every pair of the bucket is still compared. Each unit returns a
    spanning forest of its links.
    """
    keyed = ring_keys(prints)
    counts = keyed.groupBy("key").count().where(F.col("count") > 1)
    hot = staged(counts.where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "hot")
    rows = keyed.join(broadcast_if_small(hot), "key", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    rows = rows.select("key", "fp", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("block", "other").alias("r"), F.greatest("block", "other").alias("c"), "block", "fp")
    dealt = rows.repartition("key", "r", "c").sortWithinPartitions("key", "r", "c", "block")
    return dealt.mapInArrow(_bucket_edges, "a long, b long")


def near_duplicates(docs: DataFrame, row_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id``: documents whose fingerprints are linked by chains of at most three differing bits.

    Lower-cased (A to Z) words between ASCII white space, shingles of ``shingle`` words (fewer words: the whole sequence).
    Null and empty texts have fingerprint zero, which links like any other. ``component_id`` is the smallest id of the
    component, null only if all of its ids are null; rows with a null id are kept, repeated rows are repeated, other
    columns are ignored, an empty table gives no rows.

    Equal fingerprints are one row from the first grouping on, so copies are counted but never paired.
    """
    prints = staged(fingerprints(docs, row_id, text, shingle), "prints")
    groups = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "groups")
    nodes = components(links(groups.select("fp"))).select(F.col("node").alias("fp"), "root")
    groups = groups.join(nodes, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = groups.join(least, "root").select("fp", "component_id").repartition(F.xxhash64("fp"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, row_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Rows of ``docs``, with all of their columns, whose id is the smallest of their component of :func:`near_duplicates`.

    Rows with a null id stay. Of rows that share an id and a text one stays, and of rows that share an id only each whose id is the
    smallest of a component of that id. Null and empty texts are near copies of each other; texts may be of any length and
    columns of any name; an empty table gives no rows.
    """
    found = near_duplicates(docs, row_id, text, shingle).where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(row_id).cast("long").alias("id"), F.xxhash64(text).alias("h"))
    first = rows.where("id is not null").join(found, "id").dropDuplicates(["id", "h"]).select("row.*")
    return first.unionByName(docs.where(F.col(row_id).isNull()))
