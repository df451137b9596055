"""Streaming Viterbi: the ids of the public library for models of merges and unigram models, windows, and the round trip."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tempoflow.llm import viterbi
from tempoflow.llm.common import read

BPE = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", "ing", " ", "  ", " " * 14, " " * 15, " " * 16, viterbi.BLANK, "日本語", "🙂", "é", "ﬁ", "\n", "\t", "\x00", "x", "<s>", "<0x0A>", "12", "==", "//"]
TEXTS = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=25).map("".join)
FIXED = ["", "a", " a  b   ", "  ", "日本語🙂x", "aaaa" * 90, "The of\nand\tthe <s>", "and the other " * 9, "x" * 70 + "é 日" * 9, "=-" * 200, "_" * 77]


def varint(n):
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)


def field(number, value):
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def write_model(path, pieces, kind, **normalizer):
    """A model made by hand: control pieces, all bytes, and ``pieces`` with their scores."""
    every = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]]
    every += [(p, s, *t) if t else (p, s, 1) for p, s, *t in pieces]
    data = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, t)) for p, s, t in every)
    data += field(2, field(3, kind) + field(35, 1))
    data += field(3, field(1, b"identity") + field(3, normalizer.get("dummy", 1)) + field(4, normalizer.get("extra", 0)))
    path.write_bytes(data)
    return str(path)


def ids(coder, text):
    return np.frombuffer(coder.encode(text), "<u4").tolist()


def streamed(coder, text, step):
    stream, got, widest = viterbi.Stream(coder.pieces), [], 0
    line = viterbi.BLANK + text.replace(" ", viterbi.BLANK)
    for k in range(0, len(line), step):
        got += stream.feed(line[k : k + step])
        widest = max(widest, len(stream.text))
    return got + stream.finish(), widest


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=BPE)


@pytest.mark.parametrize("text", FIXED)
def test_ids_are_those_of_the_library(library, text):
    own, want = viterbi.coder(BPE), library.encode(text)
    assert ids(own, text) == want
    assert own.decode(want) == library.decode(want) == text
    if text:
        got, widest = streamed(own, text, 3)
        assert got == want
        if len(set(text)) > 2:  # paths over one or two letters need not meet
            assert widest < 12 * own.pieces.longest


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_any_text_and_any_step(library, text, step):
    own, want = viterbi.coder(BPE), library.encode(text)
    assert ids(own, text) == want
    assert not text or streamed(own, text, step)[0] == want


def test_runs_of_blanks_of_every_length(library):
    own = viterbi.coder(BPE)
    for n in range(1, 80):
        for text in (" " * n, " " * n + "a", "b" + " " * n, "b" + " " * n + "\t" + " " * n):
            assert ids(own, text) == library.encode(text)


def test_the_query_gives_the_library_ids(spark, library):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r.ids for r in viterbi.encode(docs).collect()}
    want = {r.doc_id: None if r.text is None else library.encode(r.text) for r in docs.select("doc_id", "text").collect()}
    assert got == want and len(got) > 50


def pieces(seed):
    """Words over few letters with different scores in 64ths, so that sums are exact."""
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abc" + viterbi.BLANK) for _ in range(rng.randint(2, 6))) for _ in range(60)})
    return [(p, -s / 64) for p, s in zip([viterbi.BLANK, "a", "b", *words], rng.sample(range(64, 1500), len(words) + 3), strict=True)]


def full_table(scores, pieces, line):
    best, back = [0.0] + [float("-inf")] * len(line), [None] * (len(line) + 1)
    for e in range(1, len(line) + 1):
        for s in range(e):
            score = scores.get(line[s:e], pieces.unknown if e - s == 1 else None)
            if score is not None and best[s] + score > best[e]:
                best[e], back[e] = best[s] + score, s
    return best[-1]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("normalizer", [{}, {"extra": 1}, {"dummy": 0}])
def test_unigram_models(tmp_path, seed, normalizer):
    made = pieces(seed)
    path = write_model(tmp_path / "own.model", made, 1, **normalizer)
    theirs, own, rng = sentencepiece.SentencePieceProcessor(model_file=path), viterbi.Coder(path), random.Random(seed)
    for _ in range(300):
        text = "".join(rng.choice("aaabbbc  dé") for _ in range(rng.randint(0, 60)))
        want = theirs.encode(text)
        assert ids(own, text) == want
        assert own.decode(want) == theirs.decode(want)
        if not normalizer and text:
            line, scores = viterbi.BLANK + text.replace(" ", viterbi.BLANK), dict(made)
            got, _ = streamed(own, text, 5)
            known = [own.pieces.text[i] for i in got if i not in own.pieces.bytes]
            total = sum(scores[p] for p in known) + own.pieces.unknown * (len(line) - sum(map(len, known)))
            assert got == want and total == full_table(scores, own.pieces, line)


def merged(text, ranks):
    """Brute force: the first of the lowest merges, again and again."""
    parts = list(text)
    while found := [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]:
        _, k = min(found)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts


def merges(seed):
    """Pieces in an order in which each text is merged to two pieces before it."""
    rng, made = random.Random(seed), list(viterbi.BLANK + "abc")
    while len(made) < 70:
        piece = rng.choice(made) + rng.choice(made)
        if piece not in made and len(merged(piece, {p: k for k, p in enumerate(made)})) == 2:
            made.append(piece)
    return [(p, -float(k)) for k, p in enumerate(made) if p != "c"]  # the letter c stands in longer pieces only


@pytest.mark.parametrize("seed", range(6))
def test_other_models_of_merges(tmp_path, seed):
    path = write_model(tmp_path / "own.model", merges(seed), 2)
    theirs, own, rng = sentencepiece.SentencePieceProcessor(model_file=path), viterbi.Coder(path), random.Random(seed)
    for _ in range(500):
        text = "".join(rng.choice("aaabbbcc  dé") for _ in range(rng.randint(0, 60)))
        assert ids(own, text) == theirs.encode(text)
        assert not text or streamed(own, text, 4)[0] == theirs.encode(text)


def test_models_without_a_known_order_are_refused(tmp_path):
    letters = [(c, -9.0 - k) for k, c in enumerate(viterbi.BLANK + "ab")]
    with pytest.raises(ValueError, match="equal scores"):
        viterbi.Coder(write_model(tmp_path / "a.model", [*letters, ("ab", -1.0), ("ba", -1.0)], 2))
    with pytest.raises(ValueError, match="does not follow"):
        viterbi.Coder(write_model(tmp_path / "c.model", [*letters, ("aba", -1.0), ("ab", -2.0)], 2))
    with pytest.raises(ValueError, match="user-defined"):
        viterbi.Coder(write_model(tmp_path / "b.model", [*letters, ("ab", -1.0, 4)], 2))


def test_encode_decodes_to_every_text(docs, corpus):
    got = [(r.doc_id, r.n_ids, r.text_sha256) for r in viterbi.decoded(viterbi.encode(docs)).collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=BPE)
    want = [(i, len(library.encode(t or "")), None if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, t in corpus]
    assert sorted(got, key=str) == sorted(want, key=str)
