"""Byte-level BPE: the public library's ids on every kind of piece, exact appends and edits, and the round trip."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tempoflow.llm import prefixbpe, queries

FILES = ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")
BITS = [" ", "  ", "\n", "\t", "\x1c", "\xa0", "a", "the", "b", "é", "1", "!", "'s", "'re", "'", "漢", "\r\n", "\u3000", "😀"]


def library(name):
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    return prefixbpe.coder(public_tokenizers.path(request.param), None), library(request.param)


def ids(data):
    return memoryview(data).cast("i").tolist()


def test_pieces_are_encoded_as_by_the_library(pair):
    own, theirs = pair
    rng, tokens = random.Random(1), list(own.vocabulary.ranks)
    for alphabet in ([b"a"], [b"a", b"b"], [bytes([i]) for i in range(256)], tokens):
        for _ in range(1500):
            data = b"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12)))
            whole = own.vocabulary.ranks.get(data)
            got = [whole] if whole is not None else prefixbpe.Prefixes(own.vocabulary, data).tokens()
            assert got == theirs._encode_single_piece(data)


def test_every_prefix_can_be_read_off(pair):
    own, _ = pair
    data = "unthinkableness été 漢字 1234".encode()
    table = prefixbpe.Prefixes(own.vocabulary, data)
    for k in range(len(data) + 1):
        assert table.tokens(k) == prefixbpe.Prefixes(own.vocabulary, data[:k]).tokens()
        grown = prefixbpe.Prefixes(own.vocabulary, data[:k])
        grown.append(data[k:])
        assert grown.last == table.last


def test_edits_compute_only_what_is_near(pair):
    own, _ = pair
    rng = random.Random(2)
    data = bytes(rng.choice(b"etaoinshrdlu") for _ in range(4000))
    table = prefixbpe.Prefixes(own.vocabulary, data)
    for _ in range(60):
        start = rng.randint(0, len(table.data))
        end = min(len(table.data), start + rng.randint(0, 5))
        new = bytes(rng.choice(b"etaoinshrdlu") for _ in range(rng.randint(0, 5)))
        computed = table.edit(start, end, new)
        assert table.last == prefixbpe.Prefixes(own.vocabulary, bytes(table.data)).last
        assert computed < 500


def test_texts_appends_and_documents(pair):
    own, theirs = pair
    rng = random.Random(3)
    join = lambda n: "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))
    for _ in range(3000):
        text, more = join(16), join(8)
        assert ids(own.encode(text)) == theirs.encode_ordinary(text)
        assert own.appended(text, own.encode(text), more) == own.encode(text + more)
    for _ in range(1000):
        document = prefixbpe.Document(own, join(20))
        for _ in range(4):
            start = rng.randint(0, len(document.text))
            document.edit(start, min(len(document.text), start + rng.randint(0, 4)), join(3))
            assert document.ids() == theirs.encode_ordinary(document.text)
        document.append(more)
        assert document.ids() == theirs.encode_ordinary(document.text)


def test_an_edit_of_a_long_text_touches_few_pieces(pair):
    own, theirs = pair
    document = prefixbpe.Document(own, " ".join(f"word{i}" for i in range(20_000)))
    assert max(document.edit(60_000, 60_003, "new")) < 6
    assert document.ids() == theirs.encode_ordinary(document.text)
    document = prefixbpe.Document(own, "abcdefgh" * 2000)
    assert document.edit(9_000, 9_001, "zz") == (1, 1) and document.edit(9_500, 9_500, "q") == (1, 1)
    assert document.ids() == theirs.encode_ordinary(document.text)


def test_a_small_memory_changes_nothing():
    own = prefixbpe.Coder(public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN, memory=2)
    assert ids(own.encode("one two  two one\n three's")) == library(FILES[0]).encode_ordinary("one two  two one\n three's")


def test_query_against_the_library(spark, docs, no_docs, corpus, monkeypatch):
    theirs = library(FILES[0])
    monkeypatch.setattr(queries, "read", lambda s, d, n: docs)
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def expected(doc, text):
        found = theirs.encode_ordinary(text or "")
        return doc, len(found), sha(",".join(map(str, found)).encode()), sha((text or "").encode())

    got = [tuple(r) for r in queries.op13_byte_bpe(spark, "").collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted((expected(*row) for row in corpus), key=key)
    monkeypatch.setattr(queries, "read", lambda s, d, n: no_docs)
    assert queries.op13_byte_bpe(spark, "").count() == 0


def test_appending_on_the_cluster(spark):
    rows = [(1, "one two", "  three"), (2, None, "x"), (3, "a b", None), (None, "don'", "t go"), (4, "", "")]
    coded = {r["doc_id"]: r["ids"] for r in prefixbpe.encode(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    full = [(d, t, None if d == 2 else coded[d], m, 0) for d, t, m in rows]
    got = prefixbpe.append(spark.createDataFrame(full, "doc_id long, text string, ids array<int>, more string, bytes int"))
    theirs = library(FILES[0])
    assert {r["doc_id"]: r["ids"] for r in got.collect()} == {d: theirs.encode_ordinary((t or "") + (m or "")) for d, t, m in rows}
    back = prefixbpe.decode(spark.createDataFrame([(1, [0, 1]), (2, []), (3, None)], "doc_id long, ids array<int>"))
    assert [r["bytes"] for r in back.orderBy("doc_id").collect()] == [bytearray(b'!"'), bytearray(b""), None]
