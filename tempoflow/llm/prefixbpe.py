"""Byte-level BPE by dynamic programming over prefixes, with exact appends and edits, and its decoding.

Every prefix of a byte string has one encoding, and so one last token. The last token of a longer prefix is the one token that ends
there and whose merges never join with those of the last token of what stands before it. A table of last tokens is
therefore enough to read off the encoding of any prefix, to append bytes at the end, and to repair the table near an edit.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENDLESS = sys.maxsize
PAIRS = 1 << 20
SEGMENTS = 700_000
assert sys.byteorder == "little" and array("i").itemsize == 4


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Vocabulary:
    """Tokens of a rank file, the merges that make each of them, and which tokens may stand side by side."""

    def __init__(self, path: str):
        import ahocorasick

        self.ranks = read_ranks(path)
        ordered = sorted(self.ranks.items(), key=lambda item: item[1])
        self.size = [0] * (ordered[-1][1] + 1)
        self.shift = len(self.size).bit_length()
        self.longest = max(map(len, self.ranks))
        self._merges: dict[int, int] = {}
        # what stands at a token's border while its bytes are merged, from the single byte to the whole token
        self._left: dict[int, tuple[int, ...]] = {}
        self._right: dict[int, tuple[int, ...]] = {}
        self._apart: dict[int, bool] = {}
        for token, rank in ordered:
            self.size[rank] = len(token)
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    self._merges[left << self.shift | right] = rank
        self._ends = ahocorasick.Automaton()
        for token, rank in ordered:
            if len(token) == 1:
                self._left[rank] = self._right[rank] = (rank,)
            elif halves := self._halves(token, rank):
                self._left[rank] = (*self._left[halves[0]], rank)
                self._right[rank] = (*self._right[halves[1]], rank)
            else:
                continue  # merges never make it: it stands for a whole piece only
            self._ends.add_word(token.decode("latin-1"), rank)
        self._ends.make_automaton()

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that are left of ``token`` when all merges of a lower rank are done."""
        for k in range(1, len(token)):
            left, right = self.ranks.get(token[:k], rank), self.ranks.get(token[k:], rank)
            if left < rank and right < rank and left in self._right and right in self._left and self._separate(left, right, rank):
                return left, right
        return None

    def _separate(self, left: int, right: int, below: int = ENDLESS) -> bool:
        """Whether no merge of a rank under ``below`` joins the two, each of which is merged from its bytes.

        Both borders are followed upwards in the order of ranks. What stands on both sides at one time would be joined if that
        merge came before the next one on either side; of equal ranks the left one comes first.
        """
        a, b = self._right[left], self._left[right]
        i = j = 0
        while True:
            next_a = a[i + 1] if i + 1 < len(a) else below
            next_b = b[j + 1] if j + 1 < len(b) else below
            joined = self._merges.get(a[i] << self.shift | b[j], below)
            if joined < next_a and joined <= next_b and joined < below:
                return False
            if next_a <= next_b:
                if next_a == below:
                    return True
                i += 1
            else:
                j += 1

    def apart(self, left: int, right: int) -> bool:
        """:meth:`_separate` of whole tokens, with a bounded memory."""
        key = left << self.shift | right
        known = self._apart.get(key)
        if known is None:
            known = self._separate(left, right)
            if len(self._apart) < PAIRS:
                self._apart[key] = known
        return known

    def ends(self, data: str) -> Iterator[tuple[int, int]]:
        """(place of the last byte, token) of all tokens in ``data``, whose characters are bytes."""
        return self._ends.iter(data)

    def last_tokens(self, data: str) -> list[int]:
        """The last token of every prefix of ``data``, whose characters are bytes; that of the empty one is -1."""
        last = [-1]
        size, known, shift, add, done = self.size, self._apart.get, self.shift, last.append, -1
        for end, token in self._ends.iter(data):
            if end != done:
                before = last[end + 1 - size[token]]
                fits = known(before << shift | token)
                if fits is None:
                    fits = before < 0 or self.apart(before, token)
                if fits:
                    add(token)
                    done = end
        return last


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray(data)
        self.last = array("i", vocabulary.last_tokens(data.decode("latin-1"))[1:])  # last[k] belongs to the prefix of k + 1 bytes

    def _fill(self, start: int) -> Iterator[int]:
        """Compute ``last`` from byte ``start`` on; yields each place that is done."""
        v, last = self.vocabulary, self.last
        size, apart, begin, done = v.size, v.apart, max(0, start - v.longest + 1), start - 1
        for end, token in v.ends(self.data[begin:].decode("latin-1")):
            at = begin + end
            if at <= done:
                continue
            before = at - size[token]
            if before < 0 or apart(last[before], token):
                last[at] = token
                done = at
                yield at

    def append(self, more: bytes) -> None:
        """Exact: the new bytes may change tokens before them, but no entry of the table."""
        start = len(self.data)
        self.data += more
        self.last.extend([-1] * len(more))
        for _ in self._fill(start):
            pass

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes ``start`` to ``end``; returns how many entries were computed.

        Entries before the edit stay. An entry depends on as many entries and bytes before it as the longest token has, so
        once that many entries after the edit are what they were, all later ones are too.
        """
        old = self.last[end:]
        self.data[start:end] = new
        self.last[start:end] = array("i", [-1] * len(new))
        edited, same, computed = start + len(new), 0, 0
        if start >= len(self.data):
            return 0
        for at in self._fill(start):
            computed += 1
            if at >= edited:
                same = same + 1 if old[at - edited] == self.last[at] else 0
                if same == self.vocabulary.longest:
                    break
        return computed

    def tokens(self, length: int | None = None) -> list[int]:
        """The encoding of the first ``length`` bytes, by default of all."""
        at, out, size = (len(self.data) if length is None else length) - 1, [], self.vocabulary.size
        while at >= 0:
            out.append(token := self.last[at])
            at -= size[token]
        out.reverse()
        return out


class Coder:
    """Ids of whole texts: a pattern cuts them into pieces, and each piece is encoded by its prefixes.

    Before a space that no white space follows a new piece always starts, and what comes before it is cut as if the text ended
    there. So texts are cut at such spaces and frequent segments are remembered.
    """

    def __init__(self, path: str, pattern: str, memory: int = SEGMENTS):
        import regex

        self.vocabulary = Vocabulary(path)
        self.pieces = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}  # a segment without its space
        self._words: dict[str, bytes] = {}
        self._memory = memory

    def piece(self, text: str) -> list[int]:
        data = text.encode("utf-8", "surrogatepass")
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            return [whole]
        last, size, out = self.vocabulary.last_tokens(data.decode("latin-1")), self.vocabulary.size, []
        at = len(last) - 1
        while at:
            out.append(token := last[at])
            at -= size[token]
        out.reverse()
        return out

    def _piece(self, text: str) -> bytes:
        known, key = (self._known, text[1:]) if text[0] == " " and len(text) > 1 and not text[1].isspace() else (self._words, text)
        ids = known.get(key)
        if ids is None:
            ids = array("i", self.piece(text)).tobytes()
            if len(known) < self._memory and len(text) < 40:
                known[key] = ids
        return ids

    def _segment(self, text: str) -> bytes:
        pieces = self.pieces(text)
        return self._piece(text) if len(pieces) == 1 else b"".join(map(self._piece, pieces))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        parts = text.split(" ")
        found: list[bytes | None] = list(map(self._known.get, parts))
        found[0] = self._segment(parts[0])
        at = 0
        try:
            while True:
                at = found.index(None, at)
                part = parts[at]
                if part and not part[0].isspace():
                    found[at] = self._remembered(part)
                    at += 1
                    continue
                end = at + 1
                while end < len(parts) and (not parts[end] or parts[end][0].isspace()):
                    end += 1
                found[at:end] = [b""] * (end - at)
                found[at - 1] = self._segment((" " if at > 1 else "") + " ".join(parts[at - 1 : end]))
                at = end
        except ValueError:
            return b"".join(found)

    def _remembered(self, part: str) -> bytes:
        ids = self._segment(" " + part)
        if len(self._known) < self._memory and len(part) < 40:
            self._known[part] = ids
        return ids

    def appended(self, text: str, ids: bytes, more: str) -> bytes:
        """Ids of ``text + more`` from those of ``text``; only what follows the last certain cut is encoded again."""
        cut = len(text)
        while (cut := text.rfind(" ", 0, cut)) > 0 and (cut + 1 == len(text) or text[cut + 1].isspace()):
            pass
        tail = text[max(cut, 0) :]
        return ids[: len(ids) - len(self.encode(tail))] + self.encode(tail + more)


class Document:
    """A text under edit: its pieces with their tables, of which an edit touches those near it only."""

    def __init__(self, coder: Coder, text: str = ""):
        self.coder = coder
        self.text = text
        self.pieces = coder.pieces(text)
        self.tables: list[Prefixes | list[int]] = [coder.piece(p) for p in self.pieces]

    def ids(self) -> list[int]:
        return [i for table in self.tables for i in (table if isinstance(table, list) else self._ids(table))]

    def _ids(self, table: Prefixes) -> list[int]:
        whole = self.coder.vocabulary.ranks.get(bytes(table.data))
        return [whole] if whole is not None else table.tokens()

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> tuple[int, int]:
        """Replace the characters ``start`` to ``end``; returns the numbers of pieces taken away and put in.

        A piece depends on itself and at most two characters behind it. From a border that old and new pieces share after the
        edit on, they are the same. A single changed piece is repaired in its own table.
        """
        first = at = 0
        while first < len(self.pieces) and at + len(self.pieces[first]) <= start - 2:
            at += len(self.pieces[first])
            first += 1
        shift, after = len(new) - (end - start), start + len(new)
        borders, place = {}, at
        for k in range(first, len(self.pieces)):
            borders[place + shift] = k
            place += len(self.pieces[k])
        borders[place + shift] = len(self.pieces)
        self.text = self.text[:start] + new + self.text[end:]
        fresh, place, last = [], at, None
        for piece in self._cut(at):
            if place >= after and place in borders:
                break
            fresh.append(piece)
            place += len(piece)
        last = borders.get(place, len(self.pieces))
        if last - first == len(fresh) == 1:
            tables = [self._repaired(first, start - at, end - at, new, fresh[0])]
        else:
            tables = [self.coder.piece(p) for p in fresh]
        self.pieces[first:last] = fresh
        self.tables[first:last] = tables
        return last - first, len(fresh)

    def _cut(self, at: int) -> Iterator[str]:
        step = 4096  # a piece that reaches the end of a part is cut again with more behind it
        while at < len(self.text):
            part, done = self.text[at : at + step], 0
            for piece in self.coder.pieces(part):
                if at + done + len(piece) + 2 > at + len(part) < len(self.text):
                    break
                yield piece
                done += len(piece)
            at, step = at + done, step if done else 2 * step

    def _repaired(self, k: int, start: int, end: int, new: str, whole: str) -> Prefixes:
        old, table = self.pieces[k], self.tables[k]
        if not isinstance(table, Prefixes):
            table = Prefixes(self.coder.vocabulary, old.encode("utf-8", "surrogatepass"))
        start, end = max(start, 0), min(end, len(old))
        if old[:start] + new + old[end:] != whole:
            return Prefixes(self.coder.vocabulary, whole.encode("utf-8", "surrogatepass"))
        at = len(old[:start].encode("utf-8", "surrogatepass"))
        table.edit(at, at + len(old[start:end].encode("utf-8", "surrogatepass")), new.encode("utf-8", "surrogatepass"))
        return table


@cache
def coder(path: str | None, pattern: str | None) -> Coder:
    """One coder per worker process, so that its memory outlives a task."""
    import public_tokenizers

    return Coder(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)


@cache
def token_bytes(path: str | None) -> dict[int, bytes]:
    """All that decoding needs."""
    import public_tokenizers

    return {rank: token for token, rank in read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).items()}


def _lists(ids: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(i) // 4 for i in ids], out=offsets[1:])
    flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 1000, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and about ``size`` bytes; a larger row is alone."""
    for batch in batches:
        n = max(1, min(rows, size * batch.num_rows // max(batch.nbytes, 1)))
        yield from (batch.slice(k, n) for k in range(0, batch.num_rows, n))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of every text, the pieces of ``pattern`` one by one, without special tokens.

    A null text counts as empty and has no ids. Texts are read whole whatever their length, null ids kept, repeated rows
    repeated, other columns ignored; an empty table gives no rows. ``path`` is a rank file on the executors, by default
    the public one of their installation. Each row is encoded where it lies; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for part in _parts(batches):
            ids = [own.encode(value.as_py() or "") for value in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=["doc_id", "ids"])

    return docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def append(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids`` of ``text`` followed by ``more``, for rows of ``doc_id, text, ids, more`` with the ids of ``text``.

    Only the end of the text that the new one can change is encoded again. Null texts count as empty, null ids of a text as not
    known: it is then encoded whole. Null and repeated ``doc_id`` are kept, other columns ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for part in _parts(batches):
            out = []
            for text, ids, more in zip(part.column(1), part.column(2), part.column(3), strict=True):
                text, more = text.as_py() or "", more.as_py() or ""
                known = own.encode(text) if not ids.is_valid else ids.values.to_numpy().astype("<i4").tobytes()
                out.append(own.appended(text, known, more))
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(out)], names=["doc_id", "ids"])

    return encoded.select(F.col("doc_id").cast("long"), "text", F.col("ids").cast("array<int>"), "more").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, bytes`` for rows of ``doc_id, ids``: the bytes that the ids stand for.

    Null ids give null bytes and no ids empty ones; an id that the vocabulary does not have fails the job. Null and repeated
    ``doc_id`` are kept, other columns ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = token_bytes(path).__getitem__
        for part in _parts(batches):
            found = [b"".join(map(token, ids.values.to_numpy().tolist())) if ids.is_valid else None for ids in part.column(1)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=["doc_id", "ids", "bytes"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, ids array<int>, bytes binary")
