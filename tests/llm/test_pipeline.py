"""The pipeline's stages against a brute-force version of each, on the rows that the stage before has kept."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tempoflow.llm import crf
from tempoflow.llm.simhash import fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(i, t, "en" if k % 2 else "fr", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(corpus)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [[tuple(r) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
        if name != "packing":
            assert docs.columns == COLUMNS
            kept[-1] = [tuple(r) for r in kept[-1]]
    raw, identified, unique, cut, packed = kept

    model = crf.train(spark.read.parquet(f"{folder}/documents.parquet"))
    found = crf.predict(model, [r[1] for r in raw])
    assert Counter(identified) == Counter(r for r, f in zip(raw, found, strict=True) if f[0] != "und")
    assert {500, 501, 502, 508} & {r[0] for r in identified} == set()

    prints = [fingerprint(r[1]) for r in identified]
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(len(prints)):
                if (prints[a] ^ prints[b]).bit_count() <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    least = {}
    for r, l in zip(identified, label, strict=True):
        if r[0] is not None:
            least[l] = min(r[0], least.get(l, r[0]))
    want = {(r[0], r[1]) for r, l in zip(identified, label, strict=True) if r[0] is not None and least[l] == r[0]}
    assert Counter((r[0], r[1]) for r in unique if r[0] is not None) == Counter(want)
    assert sum(r[0] is None for r in unique) == sum(r[0] is None for r in identified)

    seen = Counter()
    for r in unique:
        b = r[1].encode()
        seen.update(b[k : k + 200] for k in range(len(b) - 199))
    want = []
    for r in unique:
        b = r[1].encode()
        gone = [False] * len(b)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        text = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
        if text:
            want.append((r[0], text, r[2], r[3], len(text)))
    assert Counter(cut) == Counter(want)

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = Counter()
    for r in cut:
        ids[r[0]] += len(coder.encode(r[1], add_special_tokens=False).ids) + 1
    got = Counter()
    for p in packed:
        got[p.doc_id] += p.length
    assert got == ids


def test_run_equals_the_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and "sequence_id" in out.columns
