"""Runs of words and the grammar below them, against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tempoflow.llm import periodic, queries
from tempoflow.llm.recompression import Grammar


def runs_of(words, least=6, power=4):
    best = {}
    for q in range(len(words) // power, 0, -1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, power * q):
                best[start, i + q - start] = q
            i += 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def loops(rng):
    """Words with stretches that repeat, some of them inside of others."""
    words, k = [], rng.choice([1, 2, 3, 30])
    while rng.random() < 0.85:
        part = [f"w{rng.randrange(k)}" for _ in range(rng.randint(1, 8))]
        if rng.random() < 0.3 and words:
            part = words[-rng.randint(1, 12) :]
        words += part * rng.choice([1, 1, 4, 5, 9])
        if rng.random() < 0.4:
            words = words[: -rng.randint(1, 3)]
    return words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 5), st.integers(0, 40))
def test_extensions_are_those_of_the_sequence(words, power, other):
    words = words * power
    if other < len(words):
        words[other] = 7
    text = [-1, *words, -2]
    grammar = Grammar(np.array(text))
    x, y = np.array([(i, j) for j in range(len(text)) for i in range(j)]).T
    ahead, back = grammar.extensions(x, y), grammar.extensions(x, y, back=True)
    for i, j, a, b in zip(x, y, ahead, back, strict=True):
        assert text[i : i + a] == text[j : j + a] and (j + a == len(text) or text[i + a] != text[j + a])
        assert text[i - b + 1 : i + 1] == text[j - b + 1 : j + 1] and (i < b or text[i - b] != text[j - b])


def test_a_grammar_is_small_and_shares_its_names():
    word = np.random.default_rng(1).integers(0, 50, 1000)
    grammar = Grammar(np.concatenate(([-1], np.tile(word, 500), [-2])))
    assert len(grammar.levels) < 80
    assert sum(len(level.rules) for level in grammar.levels) < 20_000  # for half a million symbols
    flat = Grammar(np.concatenate(([-1], np.zeros(100_000, int), [-2])))
    assert sum(len(level.rules) for level in flat.levels) < 10
    for level in grammar.levels[:6]:  # each name has one rule, and its places spell it
        k = int(np.argmax(np.diff(level.first)))
        held = level.symbols[level.first[k] : level.first[k + 1]]
        assert len(set(held.tolist())) == 1 if level.blocks else len(held) <= 2


@pytest.mark.parametrize("least,power", [(6, 4), (8, 4), (6, 5)])
def test_runs_of_groups_of_texts(least, power):
    rng = random.Random(5)
    found = 0
    for _ in range(60):
        group, texts = periodic.Texts(least, power), [loops(rng) for _ in range(rng.randint(1, 8))]
        for words in texts:
            group.add(rng.choice([" ", "\n\t", ""]) + rng.choice([" ", "  ", "\x0b"]).join(words))
        for words, (n, runs, left) in zip(texts, group.results(), strict=True):
            expected = runs_of(words, least, power)
            assert n == len(words) and ([] if runs is None else [tuple(r) for r in runs.tolist()]) == expected
            assert left.decode() == collapsed(words, expected)
            found += len(expected)
    assert found > 200


def test_long_texts_of_one_word_and_of_nested_runs():
    group = periodic.Texts(6, 4)
    group.add("a " * 300_000)
    group.add(("a b a a b " * 5 + "c ") * 3_000)
    (_, one, left), (n, nested, _) = group.results()
    assert one.tolist() == [[0, 300_000, 1]] and left == b"a"
    assert [0, n, 26] in nested.tolist() and [0, 25, 5] in nested.tolist() and len(nested) > 3_000


def looped(doc, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = None if doc is None else zlib.crc32(str(doc).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected_row(doc, text):
    words = looped(doc, text)
    runs = runs_of(words)
    sha = lambda value: hashlib.sha256(value.encode()).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def test_query_against_brute_force(spark, docs, no_docs, corpus, monkeypatch):
    rng = random.Random(6)
    extra = [(1000 + i, " ".join(loops(rng))) for i in range(120)]
    more = spark.createDataFrame([(i, t, "en", "s", 1, 2, None, "x") for i, t in extra], docs.schema)
    monkeypatch.setattr(queries, "read", lambda s, d, n: docs.union(more))
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, "").collect()]
    key = lambda r: tuple(map(str, r))
    expected = [expected_row(*row) for row in [*corpus, *extra]]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in extra) > 5 and sum(r[1] > 1 for r in expected) > 20
    monkeypatch.setattr(queries, "read", lambda s, d, n: no_docs)
    assert queries.op11_periodic_runs(spark, "").count() == 0


def test_groups_do_not_change_results(spark, docs, monkeypatch):
    whole = sorted(map(str, periodic.find_runs(docs).collect()))
    monkeypatch.setattr(periodic, "GROUP_WORDS", 50)
    assert sorted(map(str, periodic.find_runs(docs).collect())) == whole
    with pytest.raises(ValueError):
        periodic.find_runs(docs, power=2)
