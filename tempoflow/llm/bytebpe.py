"""Byte-level BPE ids with a bounded memory of words; equal to the ``tokenizers`` file of the same vocabulary."""

from __future__ import annotations

import base64
import sys
from array import array
from functools import cache

SPECIAL = "<|endoftext|>"  # Fixed value: the vocabulary's special token
SPECIAL_ID = 50256
assert sys.byteorder == "little" and array("I").itemsize == 4


class ByteBPE:
    """Ids as little-endian unsigned 32-bit bytes.

    A text is cut before single spaces and line ends that stand between other characters; the vocabulary's pattern always
    starts a new token there, so the ids of a part do not depend on its neighbours and frequent parts are remembered.
    """

    def __init__(self, ranks_path: str, limit: int = 300_000):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._encode, self._single, self._limit = coder.encode_ordinary, coder._encode_single_piece, limit
        self._plain: dict[str, bytes] = {}
        self._spaced: dict[str, bytes] = {}
        self._line = self._ids("\n")

    def _ids(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()

    def _known(self, memory: dict, prefix: str, part: str) -> bytes:
        found = memory.get(part)
        if found is None:
            if part.isalpha():  # letters are one piece of the pattern
                found = array("I", self._single(prefix + part)).tobytes()
            elif part[-1] in ",." and part[:-1].isalpha():
                found = self._known(memory, prefix, part[:-1]) + self._known(self._plain, "", part[-1])
            else:
                found = self._ids(prefix + part)
            if len(memory) < self._limit and len(part) < 40:
                memory[part] = found
        return found

    def _word(self, memory: dict, prefix: str, part: str) -> bytes:
        """``part`` neither starts nor ends with white space."""
        if len(pieces := part.split()) == 1:
            return self._known(memory, prefix, part)
        lines = part.split("\n")
        if len(lines) == len(pieces) and lines == pieces:
            out = [self._known(memory, prefix, lines[0])]
            for line in lines[1:]:
                out += (self._line, self._known(self._plain, "", line))
            return b"".join(out)
        return self._ids(prefix + part)

    def _ordinary(self, text: str) -> bytes:
        parts = text.split(" ")
        found = list(map(self._spaced.get, parts))
        found[0] = self._plain.get(parts[0])
        at, end = 0, len(parts)
        try:
            while True:
                at = found.index(None, at)
                first = last = at
                part = parts[at]
                if part and not part[0].isspace() and not part[-1].isspace():
                    found[at] = self._word(self._spaced if at else self._plain, " " if at else "", part)
                    at += 1
                    continue
                # white space meets white space: take the neighbours in and encode the stretch as one
                while first and (not parts[first] or parts[first][0].isspace() or not parts[first - 1] or parts[first - 1][-1].isspace()):
                    first -= 1
                while last + 1 < end and (not parts[last] or parts[last][-1].isspace() or not parts[last + 1] or parts[last + 1][0].isspace()):
                    last += 1
                found[first : last + 1] = [b""] * (last + 1 - first)
                found[first] = self._ids((" " if first else "") + " ".join(parts[first : last + 1]))
                at = last + 1
        except ValueError:
            return b"".join(found)

    def encode(self, text: str) -> bytes:
        if SPECIAL not in text:
            return self._ordinary(text) if text else b""
        mark = array("I", [SPECIAL_ID]).tobytes()
        return mark.join(self._ordinary(part) if part else b"" for part in text.split(SPECIAL))


@cache
def coder(ranks_path: str) -> ByteBPE:
    """One coder per worker process, so that its memory outlives a task."""
    return ByteBPE(ranks_path)
