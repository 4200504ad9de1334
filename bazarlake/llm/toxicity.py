"""Toxic spans by a linear-chain conditional random field, aggregated to a document score.

Model: two states per word, clean and toxic. A word's emission is the sum of hashed weights of
its spelling (whole, first and last letters); two-by-two transition weights tie neighbours.
Forward-backward gives each word's marginal; a document's score is a logistic function of its
largest marginal and of the expected number of toxic words. Spans are the words above one half.

Labels are given per document, so words are labelled first: a word of a toxic document counts as
toxic if its spelling, or its first letters, occur almost only in toxic documents of the sample.
The model is fitted on the driver over a bounded sample (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``
documents, those with the smallest hash of their id) and broadcast: ``2 ** BITS`` single floats.
Scoring reads every text whole; neither id, source, language nor label enters a score.

Defined cases: null and empty texts get the score of no evidence, which is low; null labels and
labels other than 0 and 1 are left out; repeated rows are scored alike; without labelled rows of
both classes every score is 0. Long texts are scanned in blocks, so memory follows one text.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain as joined

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import row_of, utf8, words_of
from bazarlake.llm.encoding import in_groups

SAMPLE_TOXIC = 800
SAMPLE_CLEAN = 1600
BITS = 18
EPOCHS = 30
CUT = 0.7
_BATCH_BYTES = 1 << 20
_CACHED_WORDS = 200_000
_FIT_TOKENS = 100_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _features(word: bytes) -> list[int]:
    bare = word.strip(b".,;:!?\"'()") or word
    mask = (1 << BITS) - 1
    parts = (b"w" + bare, b"3" + bare[:3], b"4" + bare[:4], b"5" + bare[:5], b"s" + bare[-3:], b"")
    return [zlib.crc32(p) & mask for p in parts]


# ---------------------------------------------------------------- chain


def _scan(m: np.ndarray) -> np.ndarray:
    """Normalised row vectors of all prefix products of the matrices ``m[t]`` (n, 2, 2).

    Blocks advance side by side and are joined by their carries, so the Python loops have about
    the square root of n steps.
    """
    n = len(m)
    length = max(1, int(np.sqrt(n)))
    blocks = -(-n // length)
    padded = np.zeros((blocks * length, 2, 2))
    padded[:n] = m
    padded[n:] = np.eye(2)
    steps = np.ascontiguousarray(padded.reshape(blocks, length, 2, 2).transpose(1, 2, 3, 0))
    product = np.empty_like(steps)
    last = np.zeros((2, 2, blocks))
    last[0, 0] = last[1, 1] = 1.0
    for t in range(length):
        a = steps[t]
        new = last[:, :1] * a[:1] + last[:, 1:] * a[1:]
        new /= new.sum(axis=(0, 1))
        product[t] = last = new
    carry = np.empty((2, blocks))
    v0 = v1 = 0.5
    for b in range(blocks):
        carry[0, b], carry[1, b] = v0, v1
        p = last[:, :, b]
        v0, v1 = v0 * p[0, 0] + v1 * p[1, 0], v0 * p[0, 1] + v1 * p[1, 1]
        total = v0 + v1
        v0, v1 = v0 / total, v1 / total
    out = carry[0] * product[:, 0] + carry[1] * product[:, 1]  # (length, 2, blocks)
    out /= out.sum(axis=1, keepdims=True)
    return out.transpose(2, 0, 1).reshape(-1, 2)[:n]


def _forward_backward(emission: np.ndarray, sizes: np.ndarray, transition: np.ndarray):
    """Marginals of the toxic state; and expected transition counts. Chains lie end to end."""
    n = len(emission)
    first = np.zeros(n, bool)
    ends = np.cumsum(sizes)
    first[(ends - sizes)[sizes > 0]] = True
    last = np.zeros(n, bool)
    last[(ends - 1)[sizes > 0]] = True
    e = np.stack([np.ones(n), np.exp(np.clip(emission, -30, 30))], axis=1)
    t = np.exp(transition)
    step = t[None] * e[:, None, :]
    step[first] = e[first][:, None, :]
    alpha = _scan(step)
    back = np.empty_like(step)
    back[:-1] = step[1:].transpose(0, 2, 1)
    back[last] = 1.0
    beta = _scan(back[::-1])[::-1]
    both = alpha * beta
    marginal = both[:, 1] / both.sum(axis=1)
    inner = np.flatnonzero(~first)
    pair = alpha[inner - 1][:, :, None] * t[None] * (e * beta)[inner][:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return marginal, pair.sum(axis=0)


# ---------------------------------------------------------------- model


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: intercept, weight of the largest marginal's log-odds, weight of log(1 + expected count)
    document: np.ndarray | None = None

    def emission(self, word: bytes) -> float:
        return float(self.weights[_features(word)].sum())

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.document is None:
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-np.clip(evidence @ self.document, -30, 30)))


def _evidence(marginal: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(1, log-odds of the largest marginal, log(1 + expected count)) per document."""
    out = np.zeros((len(sizes), 3))
    out[:, 0] = 1.0
    out[:, 1] = -6.0
    held = np.flatnonzero(sizes > 0)
    if len(held):
        starts = (np.cumsum(sizes) - sizes)[held]
        top = np.clip(np.maximum.reduceat(marginal, starts), 1e-4, 1 - 1e-4)
        out[held, 1] = np.clip(np.log(top / (1 - top)), -6, 6)
        out[held, 2] = np.log1p(np.add.reduceat(marginal, starts))
    return out


def _labelled_words(token: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Whether a word type counts as toxic: a spelling, or five first letters, of toxic documents only."""
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    bad, good = Counter(), Counter()
    for types, label in zip(np.split(token, np.cumsum(sizes)[:-1]), toxic, strict=True):
        (bad if label else good).update(np.unique(features[np.unique(types)][:, [0, 2, 3]]).tolist())
    strong = {
        f for f, n in bad.items() if n >= max(3, 0.015 * n_toxic) and n / n_toxic > 30 * (good[f] + 0.1) / n_clean
    }
    flags = np.zeros(1 << BITS, bool)
    flags[list(strong)] = True
    return flags[features[:, [0, 2, 3]]].any(axis=1)


def _unlike(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Index and words of documents that share neither of two minimum shingle hashes with an earlier one.

    Else the chance words of a much copied document would look like signs of its label.
    """
    seen: set[tuple[int, int]] = set()
    for i, text in enumerate(texts):
        words = words_of(text)
        shingles = {b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))}
        least = [(seed, min(zlib.crc32(s, seed) for s in shingles)) for seed in (1, 2)]
        if seen.isdisjoint(least):
            yield i, words
        seen.update(least)


def fit_sample(texts: list[bytes], toxic: list[int], epochs: int = EPOCHS) -> Model:
    """Fits the field on labelled documents held in memory, with the words of one of them at a time."""
    types: dict[bytes, int] = {}
    chosen, token = [], array("i")
    sizes = []
    for i, words in _unlike(texts):
        chosen.append(i)
        sizes.append(len(words))
        token.extend([types.setdefault(w, len(types)) for w in words])
    label = np.array([toxic[i] for i in chosen], bool)
    if label.all() or not label.any() or not types:
        return Model()
    features = np.fromiter(joined.from_iterable(map(_features, types)), np.int64).reshape(len(types), -1)
    sizes, token, n_types = np.array(sizes), np.frombuffer(token, np.int32), len(types)
    del types
    bad_type = _labelled_words(token, sizes, label, features)
    y = bad_type[token] & np.repeat(label, sizes)
    inner = np.ones(len(token), bool)
    inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
    at = np.flatnonzero(inner)
    seen = np.bincount(y[at - 1] * 2 + y[at], minlength=4).reshape(2, 2).astype(float)

    weights, transition = np.zeros(1 << BITS), np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((2, 2)), np.zeros((2, 2))]

    def adam(value, gradient, i, k, rate=0.3):
        moments[i] = 0.9 * moments[i] + 0.1 * gradient
        moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * gradient**2
        return value + rate * (moments[i] / (1 - 0.9**k)) / (np.sqrt(moments[i + 1] / (1 - 0.99**k)) + 1e-6)

    flat, repeat = features.ravel(), features.shape[1]
    bounds = np.concatenate([[0], np.cumsum(sizes)])

    def swept(emission: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward, some documents at a time to bound the memory."""
        marginal, expected = np.empty(len(token)), np.zeros((2, 2))
        for low, high in in_groups(sizes.tolist(), _FIT_TOKENS):
            own = slice(bounds[low], bounds[high])
            if bounds[low] < bounds[high]:
                marginal[own], pairs = _forward_backward(emission[token[own]], sizes[low:high], transition)
                expected += pairs
        return marginal, expected

    for k in range(1, epochs + 1):
        marginal, expected = swept(weights[features].sum(axis=1))
        per_type = np.bincount(token, y - marginal, minlength=n_types)
        gradient = np.bincount(flat, np.repeat(per_type, repeat), minlength=1 << BITS) - 0.02 * weights
        weights = adam(weights, gradient, 0, k)
        transition = adam(transition, seen - expected - 0.02 * transition, 2, k)
    model = Model(weights.astype(np.float32), transition)
    marginal, _ = swept(model.weights.astype(float)[features].sum(axis=1))
    x = _evidence(marginal, sizes)
    beta = np.zeros(3)
    for _ in range(25):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-x @ beta))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        beta += np.linalg.solve(hessian, x.T @ (label - p) - 0.05 * beta)
    model.document = beta
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learnt from. A null id counts as the text of no characters."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fits on the bounded sample of labelled rows that are not held out."""
    learnt = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & ~held_out("id")
    )
    spread = [F.xxhash64("id"), F.col("id")]
    chosen = (
        learnt.filter("label = 1").orderBy(*spread).limit(SAMPLE_TOXIC)
        .unionAll(learnt.filter("label = 0").orderBy(*spread).limit(SAMPLE_CLEAN))
    )
    texts = docs.select(F.col(doc_id).alias("id"), utf8(text).alias("bytes"))
    # At most the sizes of the sample; sorted, for the fit to be the same in every run.
    rows = texts.join(F.broadcast(chosen), "id").select("bytes", "label").distinct().orderBy("bytes", "label").limit(2 * (SAMPLE_TOXIC + SAMPLE_CLEAN)).collect()
    return fit_sample([bytes(r.bytes) for r in rows], [r.label for r in rows])


# ---------------------------------------------------------------- scoring


def _spans(text: bytes, toxic_words: np.ndarray) -> list[dict]:
    """Character offsets of runs of toxic words."""
    wanted, out = set(toxic_words.tolist()), []
    for i, match in enumerate(_WORD.finditer(text.decode("utf-8", "replace"))):
        if i in wanted:
            if out and i - 1 in wanted:
                out[-1]["stop"] = match.end()
            else:
                out.append({"start": match.start(), "stop": match.end()})
    return out


def _score_texts(texts: list[bytes], model: Model, known: dict[bytes, float]):
    emissions, sizes = [], []
    for text in texts:
        words = words_of(text)
        values = list(map(known.get, words))
        if None in values:
            for i, value in enumerate(values):
                if value is None:
                    word = words[i]
                    value = known.get(word)
                    if value is None:
                        value = model.emission(word)
                        if len(word) <= 64:
                            known[word] = value
                    values[i] = value
        emissions.append(np.array(values, float))
        sizes.append(len(words))
    if len(known) > _CACHED_WORDS:
        known.clear()
    size = np.array(sizes)
    chain = np.concatenate(emissions)
    marginal = _forward_backward(chain, size, model.transition)[0] if len(chain) else chain
    scores = model.score(_evidence(marginal, size))
    stop = np.cumsum(size)
    spans = []
    for i, text in enumerate(texts):
        own = np.flatnonzero(marginal[stop[i] - size[i] : stop[i]] > 0.5)
        spans.append(_spans(text, own) if len(own) else [])
    return scores.tolist(), spans


_RESULT = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def score_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct of score and spans for each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("score double, spans array<struct<start: bigint, stop: bigint>>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[bytes, float] = {}
        for batch in batches:
            scores, spans, held, size = [], [], [], 0
            for i in range(len(batch)):
                held.append(batch[i].as_py())
                size += len(held[-1])
                if size > _BATCH_BYTES or i + 1 == len(batch):
                    part = _score_texts(held, shared.value, known)
                    scores += part[0]
                    spans += part[1]
                    held, size = [], 0
            yield pa.array([{"score": a, "spans": b} for a, b in zip(scores, spans, strict=True)], _RESULT)

    return scored(utf8(text))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """Per row: id, ``held_out``, ``score``, ``predicted`` and the offending character ``spans``."""
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = held.select("doc_id", score_column(held, model).alias("found"))
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= cut).cast("int").alias("predicted"),
        F.col("found.spans").alias("spans"),
    )


def clean_rows(docs: DataFrame, model: Model, text: str = "text", cut: float = CUT) -> DataFrame:
    """The rows that score below the cut, with all their columns."""
    held = docs.select(row_of(docs).alias("__row"), F.col(text).alias("text"))
    return held.select("__row", score_column(held, model).alias("found")).filter(F.col("found.score") < cut).select("__row.*")
