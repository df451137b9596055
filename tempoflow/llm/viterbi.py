"""SentencePiece encoding by streaming Viterbi, and decoding: the ids of unigram models and of models of merges (BPE)."""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.prefixbpe import Vocabulary

BLANK = "▁"
MEMORY = 600_000
PAIRS = 1 << 19
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + size]
            at += size


# fixed values of the model format: numbers of fields, kinds of models and of pieces
PIECE, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TYPE, MODEL_TYPE, RULES, DUMMY_PREFIX, EXTRA_BLANKS, ESCAPE = 3, 3, 2, 3, 4, 5
UNIGRAM, BPE = 1, 2
USER_DEFINED, UNUSED = 4, 5


class Merges(Vocabulary):
    """Which pieces of a model of merges may stand side by side.

    Every piece must come after two others that its own text is merged to, as training leaves it; then a piece is made at one time only.
    Letters come before all merges, and merges in the order of falling scores, which must differ. Only runs of blanks may share a
    score, the lowest one: equal scores go from left to right after all other merges (``runs`` has the pairs of lengths that stay apart).
    """

    def __init__(self, scores: dict[str, float]):
        letters = sorted({letter for piece in scores for letter in piece})
        merged = sorted((piece for piece in scores if len(piece) > 1), key=lambda piece: (-scores[piece], not piece.strip(BLANK)))
        self.runs: set[tuple[int, int]] = set()
        equal = {p for pair in zip(merged, merged[1:], strict=False) if scores[pair[0]] == scores[pair[1]] for p in pair}
        if equal:
            runs = {piece for piece in merged if not piece.strip(BLANK)}
            if equal != runs or {*merged[-len(runs) :]} != runs or any(BLANK * 2 in piece for piece in merged[: -len(runs)]):
                raise ValueError("merges of equal scores have no known order")
            self.runs = _run_pairs({len(piece) for piece in runs})
            del merged[-len(runs) :]
        self.ranks = {piece: rank for rank, piece in enumerate([*letters, *merged])}
        self.shift = len(self.ranks).bit_length()
        self._merges, self._left, self._right = {}, {}, {}
        for piece, rank in self.ranks.items():
            for k in range(1, len(piece)):
                left, right = self.ranks.get(piece[:k]), self.ranks.get(piece[k:])
                if left is not None and right is not None:
                    self._merges[left << self.shift | right] = rank
        for piece, rank in self.ranks.items():
            if len(piece) == 1:
                self._left[rank] = self._right[rank] = (rank,)
            elif halves := self._halves(piece, rank):
                self._left[rank] = (*self._left[halves[0]], rank)
                self._right[rank] = (*self._right[halves[1]], rank)
            else:
                raise ValueError(f"piece {piece!r} does not follow from those before it")


def _run_pairs(lengths: set[int]) -> set[tuple[int, int]]:
    """Neighbours in runs of blanks that are merged from left to right, as long as the sum of two neighbours is one of ``lengths``."""
    longest, cut = max(lengths), {}
    for size in range(1, 4 * longest + 1):
        parts, k = [1] * size, 0
        while k + 1 < len(parts):
            if parts[k] + parts[k + 1] in lengths:
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                k = max(k - 1, 0)
            else:
                k += 1
        cut[size] = parts
    pairs = {pair for parts in cut.values() for pair in zip(parts, parts[1:], strict=False)}
    for size, parts in cut.items():
        ends = [k for k in {1, *lengths} if k == size or (k < size and (cut[size - k][-1], k) in pairs)]
        if ends != parts[-1:]:
            raise ValueError("runs of blanks are not settled by pairs of pieces")
    return pairs


class Pieces:
    """A model's pieces as a tree of characters, with scores, and the bytes that stand in for unknown characters.

    In a unigram model a path's score is the sum of those of its pieces. In a model of merges (BPE) scores are only the order in which
    pieces are merged, and a path counts if the merges that make its pieces never join two of them (``fits``): 0 for
    such a path, none for others, and each prefix has exactly one.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text: list[str] = []
        self.bytes: dict[int, int] = {}
        self.byte_ids = [0] * 256
        self.tree: dict = {}
        self.longest = 1
        self.control: set[int] = set()
        scores: dict[int, float] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.text.append(piece)
            if model.is_byte(i):
                self.bytes[i] = int(piece[3:5], 16)
                self.byte_ids[self.bytes[i]] = i
            elif model.is_control(i) or model.is_unknown(i):
                self.control.add(i)
            else:
                scores[i] = model.get_score(i)
        kind = self._read(model)
        if len(self.bytes) < 256:
            raise ValueError("the model has no bytes for unknown characters")
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.merges = Merges({self.text[i]: score for i, score in scores.items()}) if kind == BPE else None
        self.ranks: dict[int, int] = {}
        self.runs: dict[int, int] = {}
        if self.merges:
            self._rank({i: self.text[i] for i in scores})
            self.unknown, scores = 0.0, dict.fromkeys(scores, 0.0)
        for i, score in scores.items():
            self._grow(self.text[i], i, score)
        self.pairs: dict[tuple[int, int], bool] = {}

    def _rank(self, pieces: dict[int, str]) -> None:
        """Ranks of pieces by their ids; runs of blanks of one score count as their single blanks towards other pieces."""
        ranks = self.merges.ranks
        for i, piece in pieces.items():
            if self.merges.runs and not piece.strip(BLANK):
                self.runs[i], self.ranks[i] = len(piece), ranks[BLANK]
            else:
                self.ranks[i] = ranks[piece]
        for k, letter in enumerate(sorted({p for p in ranks if len(p) == 1} - {*pieces.values()}), 2):
            self._grow(letter, -k, 0.0)  # it stands in longer pieces only; alone it is written as bytes
            self.ranks[-k] = ranks[letter]

    def _read(self, model) -> int:
        """The kind of the model, and how it prepares texts."""
        kind, rules = UNIGRAM, {RULES: b"", DUMMY_PREFIX: 1, EXTRA_BLANKS: 1, ESCAPE: 1}
        for number, part in _fields(model.serialized_model_proto()):
            if number == PIECE and any(n == PIECE_TYPE and v in (USER_DEFINED, UNUSED) for n, v in _fields(part)):
                raise ValueError("user-defined and unused pieces are not known here")
            if number == TRAINER:
                kind = next((v for n, v in _fields(part) if n == MODEL_TYPE), UNIGRAM)
            elif number == NORMALIZER:
                rules |= {n: v for n, v in _fields(part) if n in rules}
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram models and models of merges are known here")
        if not rules[ESCAPE]:
            raise ValueError("the model does not mark blanks")
        self.normalize = None if rules == {RULES: b"", DUMMY_PREFIX: 1, EXTRA_BLANKS: 0, ESCAPE: 1} else model.normalize
        self.leading = bool(rules[DUMMY_PREFIX] or rules[EXTRA_BLANKS])  # decoding drops a blank at the start
        return kind

    def _grow(self, piece: str, i: int, score: float) -> None:
        node = self.tree
        for letter in piece:
            node = node.setdefault(letter, {})
        node[""] = (i, score)
        self.longest = max(self.longest, len(piece))

    def fits(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``before``; -1 is the start of the text or a character that is in no piece."""
        if before == -1:
            return True
        known = self.pairs.get((before, piece))
        if known is None:
            if before in self.runs and piece in self.runs:
                known = (self.runs[before], self.runs[piece]) in self.merges.runs
            else:
                known = self.merges._separate(self.ranks[before], self.ranks[piece])
            if len(self.pairs) < PAIRS:
                self.pairs[before, piece] = known
        return known


class Stream:
    """Ids of the segmentation with the best score, given out while the text comes in.

    Scores are kept for a window of the model's longest piece only. A boundary that no piece reaches over is on every path, and
    its ids are final; failing that, the backpointers of all places that a later piece can still start from are followed down, and
    what lies before the boundary where they meet is final too. Ties go to the longer last piece.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.text = ""  # from the last final boundary on
        self.best: list[float] = [0.0]
        self.back: list[tuple[int, int]] = [(0, -1)]  # start and last piece; that of place 0 is the last one given out
        self.done = 0  # starts worked off
        self.reach = 0
        self.cut = 0  # the last boundary that no piece reaches over
        self.look = 4 * pieces.longest  # when to follow backpointers next

    def _advance(self, last: bool) -> None:
        """Opens all starts whose pieces are known to the end: those with the longest piece's length of text before them."""
        tree, longest, text = self.pieces.tree, self.pieces.longest, self.text
        size = len(text)
        best, back = self.best, self.back
        more = size + 1 - len(best)
        best += [float("-inf")] * more
        back += [(0, -1)] * more
        fits, known = self.pieces.fits if self.pieces.merges else None, self.pieces.pairs.get
        stop = size if last else size - longest
        at, reach = self.done, self.reach
        while at < stop:
            score, before, node, end, plain = best[at], back[at][1], tree, at, False
            while end < size and (node := node.get(text[end])) is not None:
                end += 1
                if (found := node.get("")) is not None:
                    plain = plain or end == at + 1
                    if fits:
                        if best[end] == 0.0:  # each prefix has one path, and here it is
                            continue
                        fit = known((before, found[0]))
                        if not (fits(before, found[0]) if fit is None else fit):
                            continue
                    if (total := score + found[1]) > best[end]:
                        best[end], back[end] = total, (at, found[0])
                    reach = max(reach, end)
            if not plain and (total := score + self.pieces.unknown) > best[at + 1]:
                best[at + 1], back[at + 1] = total, (at, -1)
                reach = max(reach, at + 1)
            at += 1
            if reach == at:
                self.cut = at
        self.done, self.reach = at, reach

    def _ids(self, end: int) -> list[int]:
        out = []
        while end:
            start, piece = self.back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.pieces.byte_ids[b] for b in reversed(self.text[start:end].encode("utf-8", "surrogatepass"))]
            end = start
        out.reverse()
        return out

    def _commit(self, end: int) -> list[int]:
        ids = self._ids(end)
        self.text = self.text[end:]
        base = self.best[end]
        self.best = [b - base for b in self.best[end:]]
        self.back = [(max(0, s - end), p) for s, p in self.back[end:]]  # place 0 keeps its piece, which the next one must fit
        self.done, self.reach, self.cut = self.done - end, self.reach - end, 0
        return ids

    def _meeting(self) -> int:
        """Where the backpointers of all open places meet."""
        live = {e for e in range(self.done, min(len(self.best), self.reach + 1)) if self.best[e] > float("-inf")}
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(self.back[top][0])
        return live.pop() if live else 0

    def feed(self, text: str) -> list[int]:
        self.text += text
        self._advance(last=False)
        if self.cut:
            return self._commit(self.cut)
        if self.done > self.look:
            if meet := self._meeting():
                self.look = 4 * self.pieces.longest
                return self._commit(meet)
            self.look = 2 * self.done  # equal paths that never meet cost a constant share more, not a square
        return []

    def finish(self) -> list[int]:
        self._advance(last=True)
        return self._commit(len(self.text)) if self.text else []


class Coder:
    """Whole texts through :class:`Stream`; what lies between two blanks is remembered while there is room.

    No piece of the model goes on from another character into a blank (this is checked), so the boundary before a blank is on
    every path and the ids of a stretch between two of them are those of the stretch alone.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        self.pieces = Pieces(path)
        self.splits = not any(BLANK in p.lstrip(BLANK) for i, p in enumerate(self.pieces.text) if i not in self.pieces.control)
        usable = (p for i, p in enumerate(self.pieces.text) if i not in self.pieces.control and i not in self.pieces.bytes)
        self.pairs = {p[k : k + 2] for p in usable for k in range(len(p) - 1)}
        self.known: dict[str, bytes] = {}  # after a blank
        self.inner: dict[str, bytes] = {}  # after a boundary inside of a word
        self.memory = memory
        self.special = np.array([i in self.pieces.bytes or i in self.pieces.control for i in range(len(self.pieces.text))])

    def _segment(self, text: str) -> bytes:
        stream = Stream(self.pieces)
        step = 8 * self.pieces.longest
        if len(text) <= step:
            stream.text = text
            return array("I", stream.finish()).tobytes()
        out = array("I")
        for k in range(0, len(text), step):
            out.extend(stream.feed(text[k : k + step]))
        out.extend(stream.finish())
        return out.tobytes()

    def _remembered(self, memory: dict, before: str, part: str) -> bytes:
        ids = memory.get(part)
        if ids is None:
            ids = self._segment(before + part)
            if len(memory) < self.memory and len(part) < 40:
                memory[part] = ids
        return ids

    def _part(self, part: str) -> bytes:
        """What stands between two blanks, cut between letters that no piece has side by side: every path passes there."""
        cuts = [k for k, pair in enumerate(map(add, part, part[1:]), 1) if pair not in self.pairs]
        if not cuts:
            return self._remembered(self.known, BLANK, part)
        out = [self._remembered(self.known, BLANK, part[: cuts[0]])]
        out += [self._remembered(self.inner, "", part[a:b]) for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True)]
        ids = b"".join(out)
        if len(self.known) < self.memory and len(part) < 40:
            self.known[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids; blanks become the model's mark, with one before the text."""
        if not text:
            return b""
        line = BLANK + text.replace(" ", BLANK) if self.pieces.normalize is None else self.pieces.normalize(text)
        if not self.splits:
            return self._segment(line)
        parts = line.split(BLANK)
        found = list(map(self.known.get, parts))
        found[0] = self._segment(parts[0])
        at = 1
        try:
            while True:
                at = found.index(None, at)
                if not parts[at]:  # several blanks, or one at the end: they belong to the next part
                    end = at
                    while end < len(parts) and not parts[end]:
                        end += 1
                    found[at : end + 1] = [b""] * (min(end + 1, len(parts)) - at)
                    found[at] = self._segment(BLANK * (end + 1 - at if end < len(parts) else end - at) + (parts[end] if end < len(parts) else ""))
                    at = end + 1
                    continue
                found[at] = self._part(parts[at])
                at += 1
        except ValueError:
            return b"".join(found)

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        p, values = self.pieces, np.asarray(ids, np.int64)
        out, held, done = [], bytearray(), 0
        for at in np.flatnonzero(self.special[values]).tolist():  # pieces between these stand for themselves
            if at > done:
                out += [held.decode("utf-8", "replace"), *map(p.text.__getitem__, values[done:at].tolist())]
                held.clear()
            done, i = at + 1, int(values[at])
            if i in p.bytes:
                held.append(p.bytes[i])
            else:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
        out += [held.decode("utf-8", "replace"), *map(p.text.__getitem__, values[done:].tolist())]
        text = "".join(out).replace(BLANK, " ")
        return text[1:] if p.leading and text.startswith(" ") else text


@cache
def coder(path: str) -> Coder:
    return Coder(path)


def encode(docs: DataFrame, model: str | None = None, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of every text: those that the model's own library gives, unknown characters as bytes.

    Null texts have null ids and empty ones none. A text that holds the model's own mark for blanks gets it back as a blank, as in the model itself.
    Texts are read whole, null ids kept, repeated rows repeated, other columns ignored; an empty table gives no rows. ``model`` is a
    path on the executors, by default the public file of their installation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        own = coder(model or public_tokenizers.path("piece_bpe_32k.model"))
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                ids = [None if (v := x.as_py()) is None else own.encode(v) for x in part.column(1)]
                sizes = [0] + [len(i or b"") // 4 for i in ids]
                flat = pa.Array.from_buffers(pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(i or b"" for i in ids))])
                offsets = pa.array([None if k < len(ids) and ids[k] is None else o for k, o in enumerate(_running(sizes))], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "ids"])

    return docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def _running(sizes: list[int]) -> Iterator[int]:
    total = 0
    for s in sizes:
        total += s
        yield total


DIGEST = "doc_id long, n_ids long, ids_crc32 long, text_sha256 string"


def decoded(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, text_sha256``: ids counted and digested, and the digest of the text that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        own = coder(model or public_tokenizers.path("piece_bpe_32k.model"))
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                out: list[list] = [[], [], []]
                for ids in part.column(1):
                    if not ids.is_valid:
                        for o, v in zip(out, (0, 0, None), strict=True):
                            o.append(v)
                        continue
                    values = ids.values.to_numpy()
                    out[0].append(len(values))
                    out[1].append(zlib.crc32(values.astype("<u4").tobytes()))
                    out[2].append(hashlib.sha256(own.decode(values).encode("utf-8", "surrogatepass")).hexdigest())
                kinds = (pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(o, k) for o, k in zip(out, kinds, strict=True))], names=["doc_id", "n_ids", "ids_crc32", "text_sha256"])

    return encoded.mapInArrow(run, DIGEST)
