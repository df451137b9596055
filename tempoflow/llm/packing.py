"""Hierarchical multi-length packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.bytebpe import coder

TIERS = (1024, 512, 256, 128)
STEP = 64
POOL_TOKENS = 2_000_000

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)


class Packer:
    """Packs pieces of documents of one partition; holds at most a pool and what is left of the one before.

    Whole windows are cut from the front of long documents. What is left of each goes to the tier of the smallest window
    that holds it. Windows are opened from the longest piece down and filled with the largest shorter pieces that fit;
    when none fits, the shortest piece is cut. Only the end of a partition can leave an open window, which is cut into
    sequences of powers of two.
    """

    def __init__(self, tiers=TIERS, step: int = STEP):
        self.tiers, self.step = tuple(sorted(tiers, reverse=True)), step
        self.pool: list[list] = [[] for _ in range(self.tiers[0])]
        self.mask = self.tokens = self.sequences = self.groups = 0
        self.done: list[tuple[int, list]] = []

    def add(self, doc, ids: bytes) -> None:
        total, window = len(ids) // 4, self.tiers[0]
        for start in range(0, total - window + 1, window):
            self.done.append((window, [(doc, total, start, ids[4 * start : 4 * (start + window)])]))
        if rest := total % window:
            self._put((doc, total, total - rest, ids[4 * (total - rest) :]))
        self.tokens += total

    def _put(self, piece) -> None:
        size = len(piece[3]) // 4
        self.pool[size].append(piece)
        self.mask |= 1 << size

    def _take(self, size: int):
        piece = self.pool[size].pop()
        if not self.pool[size]:
            self.mask &= ~(1 << size)
        return piece

    def flush(self, last: bool = False) -> list[tuple]:
        while self.mask:
            longest = self.mask.bit_length() - 1
            tier = next((t for t in reversed(self.tiers) if t >= longest), self.tiers[0])
            gap, held = tier - longest, [self._take(longest)]
            while gap and self.mask:
                if fits := self.mask & ((2 << gap) - 1):
                    piece = self._take(fits.bit_length() - 1)
                else:
                    doc, total, start, ids = self._take((self.mask & -self.mask).bit_length() - 1)
                    piece = (doc, total, start, ids[: 4 * gap])
                    self._put((doc, total, start + gap, ids[4 * gap :]))
                held.append(piece)
                gap -= len(piece[3]) // 4
            if not gap:
                self.done.append((tier, held))
            elif not last:
                for piece in held:
                    self._put(piece)
                break
            else:
                self._powers(held)
        self.tokens = 0
        rows = self._rows()
        self.done = []
        return rows

    def _powers(self, held: list) -> None:
        """Sequences of powers of two, largest first, so that nothing is padded."""
        left = sum(len(p[3]) // 4 for p in held)
        queue = list(reversed(held))
        while left:
            size = gap = 1 << (left.bit_length() - 1)
            own = []
            while gap:
                doc, total, start, ids = queue.pop()
                if (n := len(ids) // 4) > gap:
                    queue.append((doc, total, start + gap, ids[4 * gap :]))
                    ids, n = ids[: 4 * gap], gap
                own.append((doc, total, start, ids))
                gap -= n
            self.done.append((size, own))
            left -= size

    def _rows(self) -> list[tuple]:
        """Pieces with their places; sequences are dealt by size, to and fro, so that step groups hold like numbers of ids."""
        order = sorted(range(len(self.done)), key=lambda i: -self.done[i][0])
        groups = max(1, -(-len(order) // self.step))
        rows = []
        for k, i in enumerate(order):
            lap, at = divmod(k, groups)
            group = self.groups + (groups - 1 - at if lap % 2 else at)
            offset = 0
            tier, held = self.done[i]
            for doc, total, start, ids in held:
                rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.sequences, offset, tier, group))
                offset += len(ids) // 4
            self.sequences += 1
        self.groups += groups
        return rows


def pack(docs: DataFrame, ranks_path: str | None = None, tiers=TIERS, step: int = STEP, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence.

    Each scan partition is packed on its own, without a shuffle; ids of sequences and step groups start at a multiple of
    2^36 per partition. Null text counts as empty: such a document is its end id alone. Null ids are kept, repeated rows are packed
    as often as they occur, other columns are ignored, an empty table gives no rows. Length of a text is not limited.
    The tokenizer file is ``ranks_path``, by default the public vocabulary of the executors' own installation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encode = coder(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")).encode
        packer, base = Packer(tiers, step), TaskContext.get().partitionId() << 36

        def out(rows):
            columns = list(zip(*rows, strict=True))
            columns[5] = [base + v for v in columns[5]]
            columns[8] = [base + v for v in columns[8]]
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, encode(value.as_py() or "") + b"\0\0\0\0")
                if packer.tokens >= POOL_TOKENS and (rows := packer.flush()):
                    yield out(rows)
        if rows := packer.flush(last=True):
            yield out(rows)

    return docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
