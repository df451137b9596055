"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.operators.ranking import first_n

TABLE_BITS = 17
LEXICON_BITS = 17
PER_LANGUAGE = 200
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 64 << 20
SPAN_WORDS = 25
ROUNDS = 12
WORDS_AT_ONCE = 1_000_000
FEATURE_BYTES = 1_000_000
UNDETERMINED = "und"

LETTER = re.compile(r"[^\W\d_]")
#: Bytes that belong to words, lower-cased; the others are white space to the features.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Weights per language; features are hashed, so the tables have a fixed size."""

    languages: list[str]
    trigrams: np.ndarray  # with the blanks at both ends of a word, so they also hold its affixes of one and two bytes
    fourgrams: np.ndarray  # affixes of three bytes and inner n-grams
    lexicon: np.ndarray  # the whole word
    transitions: np.ndarray
    start: np.ndarray


@dataclass
class Words:
    """Features of all words of some texts, laid end to end."""

    three: np.ndarray  # per byte of a word
    four: np.ndarray
    whole: np.ndarray  # per word
    first: np.ndarray  # of each word, its first place in three and four
    counts: np.ndarray  # per text


def _hash(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * MIX) >> np.uint64(64 - bits)).astype(np.int32)


def features(texts: list[bytes]) -> Words:
    line = FOLD[np.frombuffer(b" " + b" ".join(texts) + b"   ", np.uint8)]
    inside = line != 32
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    wide = line.astype(np.uint64)
    three = wide[:-3] << np.uint64(16) | wide[1:-2] << np.uint64(8) | wide[2:-1]
    four = three << np.uint64(8) | wide[3:]
    # places of a word: one blank before it up to its last byte, so grams start with the blank and end behind the word
    size = ends - begins + 1
    first = np.cumsum(size) - size
    at = np.repeat(begins - 1 - first, size) + np.arange(size.sum())
    at = np.minimum(at, len(four) - 1)
    with np.errstate(over="ignore"):
        scaled = wide * _powers(len(wide))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(scaled)))
        whole = (sums[ends] - sums[begins]) * _inverses(len(wide))[begins]
        whole ^= whole >> np.uint64(31)
        found = Words(_hash(three[at], TABLE_BITS), _hash(four[at], TABLE_BITS), _hash(whole, LEXICON_BITS), first, np.empty(0, int))
    edges = np.cumsum([1] + [len(t) + 1 for t in texts])
    found.counts = np.diff(np.searchsorted(begins, edges))
    return found


BASE = 0x100000001B3
_CACHE: dict[str, np.ndarray] = {}


def _series(name: str, base: int, n: int) -> np.ndarray:
    held = _CACHE.get(name)
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 20), np.uint64(base))
        steps[0] = 1
        with np.errstate(over="ignore"):
            held = _CACHE[name] = np.cumprod(steps)
    return held[:n]


def _powers(n: int) -> np.ndarray:
    return _series("powers", BASE, n)


def _inverses(n: int) -> np.ndarray:
    return _series("inverses", pow(BASE, -1, 1 << 64), n)


def emissions(model: Model, words: Words) -> np.ndarray:
    """Score of each language for each word: the mean of its gram weights and its lexicon weight."""
    if not len(words.first):
        return np.zeros((0, len(model.languages)), np.float32)
    size = np.diff(np.append(words.first, len(words.three)))
    out = np.take(model.lexicon, words.whole, axis=0)
    grams = np.take(model.trigrams, words.three, axis=0)
    grams += np.take(model.fourgrams, words.four, axis=0)
    out += np.add.reduceat(grams, words.first, axis=0) / np.sqrt(size, dtype=np.float32)[:, None]
    return out


def posteriors(model: Model, scores: np.ndarray, counts: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all texts side by side, word by word; also the expected transitions if ``pairs``.

    Texts are ordered by length, so step t works on those that still have a t-th word.
    """
    k = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    offsets = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    trans = np.exp(model.transitions - model.transitions.max()).astype(np.float32)
    start = np.exp(model.start - model.start.max()).astype(np.float32)
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32) if len(scores) else scores
    alpha = np.empty_like(local)
    for t in range(longest):
        at = offsets[: active[t]] + t
        now = np.take(local, at, axis=0) * (start if t == 0 else np.take(alpha, at - 1, axis=0) @ trans)
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    expected = np.zeros((k, k))
    beta = np.ones((len(sizes), k), np.float32)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = offsets[:n] + t
        m = active[t + 1] if t + 1 < longest else 0
        if m:
            ahead = np.take(local, at[:m] + 1, axis=0) * beta[:m]
            if pairs:
                before = alpha[at[:m]]
                joint = before[:, :, None] * trans[None] * ahead[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            ahead = ahead @ trans.T
            beta[:m] = ahead / ahead.sum(axis=1, keepdims=True)
        marginal = np.take(alpha, at, axis=0) * beta[:n]
        alpha[at] = marginal / marginal.sum(axis=1, keepdims=True)  # step t + 1 has no more use for alpha[t]
    return alpha, expected


def _mixed(sample: list[tuple[bytes, int]], seed: int = 7) -> tuple[list[bytes], np.ndarray]:
    """Training lines that switch language: spans of the sample's texts, each used once, dealt to lines at random.

    Spans of about :data:`SPAN_WORDS` words make staying in a language likely and leaving it possible.
    """
    rng = np.random.default_rng(seed)
    spans = []
    for text, label in sample:
        words = text.split()
        at = 0
        while at < len(words):
            n = int(rng.geometric(1 / SPAN_WORDS))
            spans.append((b" ".join(words[at : at + n]), label))
            at += n
    rng.shuffle(spans)
    lines = [b" ".join(s for s, _ in spans[k : k + 12]) for k in range(0, len(spans), 12)]
    sizes = features([s for s, _ in spans]).counts
    return lines, np.repeat(np.array([label for _, label in spans], int), sizes)


def fit(sample: list[tuple[str, str]], rounds: int = ROUNDS) -> Model:
    """Maximum conditional likelihood by gradient steps of adaptive size (Adagrad) over the whole sample."""
    languages = sorted({lang for _, lang in sample})
    k = len(languages)
    place = {lang: i for i, lang in enumerate(languages)}
    model = Model(languages, np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((1 << LEXICON_BITS, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return model
    lines, gold = _mixed([(text.encode("utf-8", "surrogatepass"), place[lang]) for text, lang in sample])
    words = features(lines)
    if not len(gold):
        return model
    size = np.diff(np.append(words.first, len(words.three)))
    owner = np.repeat(np.arange(len(size)), size)
    truth = np.zeros((len(gold), k), np.float32)
    truth[np.arange(len(gold)), gold] = 1
    firsts = np.cumsum(words.counts) - words.counts
    inner = np.ones(len(gold), bool)
    inner[firsts[words.counts > 0]] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    starts = np.bincount(gold[firsts[words.counts > 0]], minlength=k)
    power = [np.full_like(a, 1e-2) for a in (model.trigrams, model.fourgrams, model.lexicon)]
    for _ in range(rounds):
        marginal, expected = posteriors(model, emissions(model, words), words.counts, pairs=True)
        error = truth - marginal
        spread = error / np.sqrt(size)[:, None]
        for table, held, at in ((model.trigrams, power[0], words.three), (model.fourgrams, power[1], words.four)):
            for j in range(k):
                slope = np.bincount(at, spread[owner, j], 1 << TABLE_BITS).astype(np.float32)
                held[:, j] += slope * slope
                table[:, j] += 0.5 * slope / np.sqrt(held[:, j])
        for j in range(k):
            slope = np.bincount(words.whole, error[:, j], 1 << LEXICON_BITS).astype(np.float32)
            power[2][:, j] += slope * slope
            model.lexicon[:, j] += 0.3 * slope / np.sqrt(power[2][:, j])
        model.transitions += np.clip((seen - expected) / max(1, seen.sum()) * k * k, -1, 1)
        model.start += np.clip((starts - marginal[firsts[words.counts > 0]].sum(axis=0)) / max(1, starts.sum()) * k, -1, 1)
    return model


def _scored(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Emissions of all words and the number of words of each text; features take some 80 bytes a byte, so they are made in parts."""
    scores, counts, at = [], [], 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end]) < FEATURE_BYTES):
            held += len(texts[end])
            end += 1
        words = features(texts[at:end])
        scores.append(emissions(model, words))
        counts.append(words.counts)
        at = end
    return np.concatenate(scores), np.concatenate(counts)


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text: the share of its words' posterior mass that the best language has."""
    out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
    usable = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model.languages else []
    coded = [texts[i].encode("utf-8", "surrogatepass") for i in usable]
    at = 0
    while at < len(coded):
        end, held = at, 0
        while end < len(coded) and (end == at or held + len(coded[end]) < 6 * WORDS_AT_ONCE):
            held += len(coded[end])
            end += 1
        scores, counts = _scored(model, coded[at:end])
        marginal, _ = posteriors(model, scores, counts)
        first = np.cumsum(counts) - counts
        some = np.flatnonzero(counts)
        shares = np.add.reduceat(marginal.astype(np.float64), first[some], axis=0) / counts[some][:, None]
        for i, share in zip(some, shares, strict=True):
            best = int(share.argmax())
            out[usable[at + i]] = (model.languages[best], float(min(1.0, share[best])))
        at = end
    return out


def held_out(row_id: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text is divisible by 5, or there is no id."""
    return F.coalesce(F.crc32(F.col(row_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def chosen(docs: DataFrame, row_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, rows: int = SAMPLE_ROWS, bytes_: int = SAMPLE_BYTES) -> list:
    """Rows ``lang, h, t, size`` that stand for the texts to fit on, by a hash of the id, within ``rows`` and ``bytes_``.

    Only keys are ranked, in two steps, so no task meets more of one language than the shares times ``per_language`` keys. Texts
    above a sixteenth of the byte budget are not chosen; they are predicted like all others.
    """
    usable = docs.where(~held_out(row_id) & F.col(text).isNotNull() & F.col(lang).isNotNull())
    keyed = usable.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(row_id).alias("h"), F.xxhash64(text).alias("t"), F.octet_length(text).cast("long").alias("size"))
    ranked = first_n(keyed.where(F.col("size") <= bytes_ // 16), ["lang"], [F.col("h"), F.col("t")], per_language, "place")
    out, held = [], 0
    for r in ranked.orderBy("place", "lang").limit(rows).collect():
        held += r["size"]
        if held > bytes_:
            break
        out.append(r)
    return out


def train(docs: DataFrame, row_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, rows: int = SAMPLE_ROWS, bytes_: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``per_language`` whole texts of each language, ``rows`` and ``bytes_`` in all; see :func:`chosen`.

    Only rows with an id, a text and a language that are not held out are used. The sample's size does not depend on that of the
    table; it is the only part of the corpus that the driver sees.
    """
    keys = [(r.lang, r.h, r.t) for r in chosen(docs, row_id, text, lang, per_language, rows, bytes_)]
    if not keys:
        return fit([])
    wanted = docs.sparkSession.createDataFrame(keys, "lang string, h long, t long").distinct()
    named = docs.where(~held_out(row_id) & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(row_id).alias("h"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    found = named.join(F.broadcast(wanted), ["lang", "h", "t"])  # at most ``rows`` keys
    texts = {(r.lang, r.h, r.t): r.text for r in found.groupBy("lang", "h", "t").agg(F.first("text").alias("text")).collect()}
    return fit([(texts[k], k[0]) for k in keys])


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, model: Model, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; ``und`` and 0 if the text is null or has no letter.

    Null ids are kept (and held out), repeated rows are repeated, other columns are ignored, an empty table gives no rows. With
    nothing to learn from, every prediction is ``und``; with one language, it is that one.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: hashed tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                found = predict(held.value, part.column(2).to_pylist())
                columns = [part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    source = docs.select(F.col(row_id).cast("long").alias("doc_id"), held_out(row_id).alias("held_out"), F.col(text).alias("text"))
    return source.mapInArrow(run, SCHEMA)


def keep_identified(docs: DataFrame, model: Model, text: str = "text", min_score: float = 0.0) -> DataFrame:
    """Rows of ``docs``, with all of their columns, whose language is determined with at least ``min_score``.

    By default only ``und`` goes: null texts and texts without a letter. A higher score also drops texts whose words point
    everywhere, as short or mixed ones do, and the more so the more languages there are.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                found = predict(held.value, part.column(text).to_pylist())
                yield part.filter(pa.array([f[0] != UNDETERMINED and f[1] >= min_score for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
