import numpy as np
import pytest

WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "pra", "sto", "té") for b in ("l", "n", "r", "s", "th", "x")]


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, short periods, nulls, repeated ids and one very long text."""
    rng = np.random.default_rng(4)
    prose = lambda n: " ".join(rng.choice(WORDS, n))
    passage, line = prose(70), "the same line that every page has at its foot, and no more than that"
    texts = [(i, prose(int(rng.integers(3, 150)))) for i in range(60)]
    texts += [(100 + i, f"{prose(30)} {passage[i : 300 + 2 * i]} {prose(20)}") for i in range(15)]
    texts += [(200 + i, f"{prose(20)}\n{line}\n{prose(20)}") for i in range(25)]
    texts += [(300 + i, texts[7][1]) for i in range(9)]
    long_text = prose(400)
    texts += [(400 + i, " ".join(w if k != 17 * i else "other" for k, w in enumerate(long_text.split()))) for i in range(12)]
    texts += [(500, None), (501, ""), (502, " \t\n "), (503, "a" * 900), (504, "ab " * 300), (505, "x"), (506, "é" * 300)]
    texts += [(None, texts[3][1]), (None, None), (None, "only here"), (7, texts[7][1]), (7, texts[7][1])]
    texts += [(507, f"{prose(9000)} {passage}"), (508, "12 34 !!"), (509, "under the MIT License and under the mit license. CC-BY NC")]
    return texts


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with further columns whose names the operators use themselves."""
    rows = [(i, t, "en" if k % 3 else None, "s", k, k, None, "x") for k, (i, t) in enumerate(corpus)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, t1 long, key int, node string, copies string")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
