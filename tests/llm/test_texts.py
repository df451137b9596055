"""Operators on texts against brute force over the whole corpus."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tempoflow.llm import debruijn, licenses, packing, runlength, simhash, viterbi


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def removed(corpus, split, join, length):
    tokens = [(i, split(t or "")) for i, t in corpus]
    seen = Counter(tuple(w[k : k + length]) for _, w in tokens for k in range(len(w) - length + 1))
    out = []
    for i, w in tokens:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k : k + length])] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = join([x for x, g in zip(w, gone) if not g])
        out.append((i, len(w), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, gram, unit", [(200, 40, 1 << 20), (60, 20, 3000)])
def test_bytes_against_all_windows(docs, corpus, length, gram, unit):
    """The second case has keys with more pieces than an index holds, so the finer levels run."""
    got = rows(runlength.remove_repeats(docs, length=length, gram=gram, unit=unit), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == removed(corpus, lambda t: list(t.encode()), bytes, length)


@pytest.mark.parametrize("window, gram", [(35, 10), (8, 3)])
def test_words_against_all_windows(docs, corpus, window, gram):
    got = rows(debruijn.remove_repeats(docs, window=window, gram=gram), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = removed(corpus, lambda t: t.encode().split(), b" ".join, window)
    assert got == sorted(((i, n, r, h) for i, n, r, _, h in want), key=str)


def test_cut_texts_keep_rows_and_columns(docs, corpus):
    cut = runlength.without_repeats(docs)
    assert cut.columns == docs.columns
    assert cut.count() == len(corpus)
    assert rows(cut.where("doc_id is null"), "t1") == rows(docs.where("doc_id is null"), "t1")
    assert cut.where("doc_id = 300").first().text is not None


def test_empty_tables(no_docs):
    assert runlength.remove_repeats(no_docs).count() == 0
    assert debruijn.remove_repeats(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_first(no_docs).count() == 0
    assert licenses.scan(no_docs).count() == 0
    assert packing.pack(no_docs).count() == 0
    assert viterbi.encode(no_docs).count() == 0


def fingerprint(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + n]), 42) for k in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, docs, corpus):
    prints = [fingerprint(t, 3) for _, t in corpus]
    label = list(range(len(corpus)))
    changed = True
    while changed:
        changed = False
        for a in range(len(label)):
            for b in range(len(label)):
                if (prints[a] ^ prints[b]).bit_count() <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    least = defaultdict(list)
    for k, (i, _) in enumerate(corpus):
        if i is not None:
            least[label[k]].append(i)
    want = sorted(((i, f"{prints[k]:016x}", min(least[label[k]], default=None)) for k, (i, _) in enumerate(corpus)), key=str)
    assert rows(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want


def test_pigeonring_finds_every_link_in_blocks(spark):
    """Random fingerprints around a few centres, in blocks so small that hot buckets are cut."""
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.int64)
    values = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            v = int(c)
            for bit in rng.choice(63, int(rng.integers(1, 6)), replace=False):
                v ^= 1 << int(bit)
            values.add(v)
    values = sorted(values)
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), block=16).collect()
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        assert 0 < (e.a ^ e.b).bit_count() <= 3
        parent[find(e.a)] = find(e.b)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                assert find(a) == find(b)


def test_keep_first_keeps_one_of_each_group(docs, corpus):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {300 + i for i in range(9)} & set(ids)
    assert ids.count(7) == 1
    assert ids.count(None) == 3
    assert set(range(60)) <= set(ids)


def _folded(n):
    """A sequence and its complement that polynomial hashes modulo a power of two cannot tell apart."""
    line = "a"
    while len(line) < n:
        line += line.translate({97: 98, 98: 97})
    return line, line.translate({97: 98, 98: 97})


def test_words_that_polynomial_hashes_confuse_stay(spark):
    one, two = _folded(4096)
    around = [f"w{i}" for i in range(60)]
    texts = [" ".join([*around[:20], one, *around[20:40]]), " ".join([*around[:20], two, *around[20:40]]), " ".join(around[:34]), f"{one} {two} {one}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in debruijn.remove_repeats(df).orderBy("doc_id").collect()] == [0, 0, 0, 0]
    same = spark.createDataFrame([(0, texts[0]), (1, texts[0] + " end"), (2, texts[1])], "doc_id long, text string")
    assert [r.n_removed for r in debruijn.remove_repeats(same).orderBy("doc_id").collect()] == [41, 41, 0]


def test_licenses_base_places(docs, corpus):
    table = {r.doc_id: r for r in licenses.scan(docs).collect() if r.doc_id is not None}
    r = table[509]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (12, 3, 0, 9, "cc-by-nc,mit")
    assert {"cc-by-nc", "mit"} <= set(r.labels.split(",")) and 0 < r.score <= 1
    assert (table[500].n_words, table[500].n_base, table[500].first_word, table[500].labels) == (0, 0, None, "")


def test_license_rules_have_their_keyword():
    assert 200 < len(licenses.rules())
    for label, text in {
        "gpl-3.0": "licensed under the GNU General Public License version 3",
        "lgpl-2.1": "Released under the LGPL v2.1",
        "bsd-3": "SPDX-License-Identifier: BSD-3-Clause",
        "cc-by-sa-4.0": "CC BY-SA 4.0 license, licensed under CC BY-SA 4.0",
        "mpl-2.0": "subject: licence Mozilla Public License, version 2.0",
        "isc": "under the ISC license",
    }.items():
        assert label in licenses.scan_text(text)[5].split(","), label


@pytest.mark.parametrize(
    "text, labels",
    [
        ("under the Apache 2.0 license", "apache-2.0"),
        ("GPL v3 license", "gpl-3.0"),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2.0,mit"),
        ("SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) AND X", "classpath-exception-2.0,gpl-2.0"),
        ("Apache License Version 2.0", "apache-2,apache-2.0"),
        ("my driver license vim", ""),
        ("the Vim license", "vim"),
        ('license = "MIT AND BSD-3-Clause"', "bsd-3,mit"),
        ("see https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa-4.0"),
        ("License :: OSI Approved :: MIT License", "mit"),
        ("CC BY 4.0 license", "cc-by-4.0"),
        ("a mitten, a licensee and open fonts", ""),
    ],
)
def test_license_lines(text, labels):
    assert licenses.scan_text(text)[5] == labels


def test_every_sentence_and_place_is_found():
    for label, pattern, *_ in licenses.SENTENCES + licenses.PLACES:
        assert licenses._keyword(pattern).isalnum()
    for label, pattern, *_ in licenses.SENTENCES:
        if pattern.replace(" ", "").isalnum():
            spans = licenses.scan_text(f"before it {pattern} and after")[7]
            assert any(s.startswith(f"{label}:") or int(s.split("-")[-1]) > 3 for s in spans), pattern
    patterns = [r.pattern.pattern for r in licenses.rules()]
    assert len(patterns) == len(set(patterns)) > 600


def test_base_places_of_all_texts(docs, corpus):
    import re

    def recount(text):
        words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        at = [(i, n) for p, n in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in at]
        return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in at}))

    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()), key=str)
    assert got == sorted(((i, *recount(t)) for i, t in corpus), key=str)
    for text in ("cc by nc cc by nc", "Apache License, Version 2 apache license version 20", "CC-BY-NC " * 50, "é under the MIT license", "under the mit licensex"):
        assert licenses.scan_text(text)[:5] == recount(text)


def test_license_suppression_against_all_pairs():
    rng = np.random.default_rng(2)
    strength = lambda h: (h[2], h[1] - h[0], h[3], [-ord(c) for c in h[4]])
    for _ in range(60):
        hits = []
        for _ in range(int(rng.integers(0, 40))):
            first = int(rng.integers(0, 12))
            hits.append((first, first + int(rng.integers(1, 6)), int(rng.integers(0, 4)), float(rng.integers(1, 3)) / 2, "abc"[rng.integers(0, 3)]))
        want = {h for h in hits if not any(strength(s) > strength(h) and s[0] <= h[0] and h[1] <= s[1] for s in hits)}
        assert sorted(licenses.suppress(hits)) == sorted(want)


def test_many_mentions_take_time_in_proportion():
    import time

    took = []
    for n in (2_000, 20_000):
        start = time.process_time()
        assert len(licenses.scan_text("GPL v3 license here. MIT license here. " * n)[7]) == 2 * n
        took.append(time.process_time() - start)
    assert took[1] < 30 * took[0]


def test_license_suppression_by_containment_and_priority():
    kept = licenses.suppress([(0, 5, 3, 0.9, "a"), (1, 3, 1, 0.5, "b"), (4, 7, 1, 0.5, "c"), (0, 5, 3, 0.9, "a"), (0, 6, 1, 0.5, "d")])
    assert sorted(k[4] for k in kept) == ["a", "c", "d"]


def test_packing(docs, corpus):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = [r.asDict() for r in packing.pack(docs).collect()]
    want = Counter()
    by_total = defaultdict(list)
    for i, t in corpus:
        ids = coder.encode(t or "", add_special_tokens=False).ids + [0]
        want[i, len(ids)] += len(ids)
        by_total[i, len(ids)].append(np.array(ids, "<u4"))
    got = Counter()
    for p in pieces:
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
        assert any(zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for ids in by_total[p["doc_id"], p["doc_tokens"]])
    assert got == want
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= 1024  # nothing is padded
    groups = defaultdict(int)
    for p in pieces:
        groups[p["step_group"]] += 1
    assert len(groups) >= 1


@pytest.mark.parametrize("text", ["", ".", " a", "a ", "  a  b\n\nc \n d\t e", "x\r\n\r\n q'll don't 12 3<|endoftext|> foo   bar", " \n", "a\nb c\n d e \nf", "it's '　' x\x1c y a, b. c.. ,d .e\n.f"])
def test_byte_bpe_equals_the_library(text):
    from tempoflow.llm.bytebpe import coder

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = coder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_matching_statistics_of_every_byte():
    rng = np.random.default_rng(0)
    for _ in range(6):
        texts = [bytes(rng.choice(list(b"ab"), int(rng.integers(1, 40)))) for _ in range(int(rng.integers(1, 7)))]
        found, at = runlength.matching_statistics(texts), 0
        places = [(i, k) for i, p in enumerate(texts) for k in range(len(p))]
        for i, k in places:
            best = 0
            for j, l in places:
                n = 0
                while (i, k) != (j, l) and k + n < len(texts[i]) and l + n < len(texts[j]) and texts[i][k + n] == texts[j][l + n]:
                    n += 1
                best = max(best, n)
            assert found[at + k] == best
            at += (k == len(texts[i]) - 1) * (len(texts[i]) + 1)
