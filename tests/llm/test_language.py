"""Language ID by held-out accuracy, and its parts."""

import itertools
import zlib

import numpy as np
from conftest import DATA

from tempoflow.llm import crf
from tempoflow.llm.common import read


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    model = crf.Model(["a", "b", "c"], None, None, None, rng.normal(size=(3, 3)), rng.normal(size=3))
    counts = np.array([3, 1, 0, 4])
    scores = rng.normal(size=(8, 3)).astype(np.float32)
    marginal, expected = crf.posteriors(model, scores, counts, pairs=True)
    want, pairs = np.zeros((8, 3)), np.zeros((3, 3))
    for first, n in zip(np.cumsum(counts) - counts, counts):
        if not n:
            continue
        paths = list(itertools.product(range(3), repeat=int(n)))
        weight = [np.exp(model.start[p[0]] + sum(scores[first + k, y] for k, y in enumerate(p)) + sum(model.transitions[a, b] for a, b in zip(p, p[1:]))) for p in paths]
        for p, w in zip(paths, np.array(weight) / sum(weight)):
            for k, y in enumerate(p):
                want[first + k, y] += w
            for a, b in zip(p, p[1:]):
                pairs[a, b] += w
    assert np.allclose(marginal, want, atol=1e-4)
    assert np.allclose(expected, pairs, atol=1e-4)


def test_held_out_accuracy(spark):
    docs = read(spark, DATA.replace("0.001", "0.01"), "documents")
    rows = {r.doc_id: r for r in crf.identify(docs, crf.train(docs)).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert rows.keys() == truth.keys()
    held = [i for i in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert np.mean([rows[i].lang_pred == truth[i] for i in held]) > 0.95


def test_words_of_a_mixed_text_are_labelled():
    sample = [("the and that with this from they have", "en")] * 9 + [("der und nicht eine mit sich auch werden", "de")] * 9
    model = crf.fit(sample)
    words = crf.features([b"the and that with und nicht eine der"])
    marginal, _ = crf.posteriors(model, crf.emissions(model, words), words.counts)
    assert [model.languages[k] for k in marginal.argmax(axis=1)] == ["en"] * 4 + ["de"] * 4


def test_hard_rows(spark, docs, corpus, no_docs):
    model = crf.fit([("the and that", "en"), ("der und das", "de")])
    rows = crf.identify(docs, model).collect()
    assert len(rows) == len(corpus)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (500, 501, 502, 508):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert all(0 <= r.score <= 1 for r in rows)
    kept = crf.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in corpus)
    assert crf.identify(no_docs, crf.train(no_docs)).count() == 0
    assert {r.lang_pred for r in crf.identify(docs, crf.train(no_docs)).collect()} == {"und"}
    only = crf.fit([("the", "en")])
    assert crf.predict(only, ["x", "1", None]) == [("en", 1.0), ("und", 0.0), ("und", 0.0)]


def test_a_low_score_alone_rejects_nothing(spark):
    """A model of eight languages whose weights are all zero: each of them gets an eighth."""
    model = crf.fit([("ka lo mi nu pe", f"l{k}") for k in range(8)])
    for weights in (v for v in vars(model).values() if isinstance(v, np.ndarray)):
        weights[...] = 0
    texts = ["ka lo mi nu pe", "mi ka", "12 !!", None]
    found = crf.predict(model, texts)
    assert all(f[0] != "und" and f[1] < 0.3 for f in found[:2])
    kept = crf.keep_identified(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1]


def test_the_sample_is_bounded_by_rows_and_bytes(spark):
    """A language that has nearly all rows, repeated rows, and one text of 50 MB; keys alone are ranked."""
    rows = [(i, f"ka lo {i}", "a") for i in range(900)] + [(i, f"mi nu {i}", "b") for i in range(2000, 2030)]
    rows += [(5, "ka lo 5", "a")] * 3 + [(4001 + k, "pe " * (50 << 20 if k == 3 else 1), "c") for k in range(12)]
    docs = spark.createDataFrame([(i, t[: 50 << 20], n) for i, t, n in rows], "doc_id long, text string, lang string")
    picked = crf.chosen(docs, per_language=20)
    assert {n: sum(r.lang == n for r in picked) for n in "ab"} == {"a": 20, "b": 20}
    assert all(r["size"] <= crf.SAMPLE_BYTES // 16 for r in picked)
    assert sum(r["size"] for r in crf.chosen(docs, bytes_=400)) <= 400
    assert len(crf.chosen(docs, rows=7)) == 7
    model = crf.train(docs, per_language=20)
    assert model.languages == ["a", "b", "c"]
    assert [n for n, _ in crf.predict(model, ["ka lo 7", "mi nu 7"])] == ["a", "b"]
