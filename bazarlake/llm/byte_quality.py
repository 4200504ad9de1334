"""Text quality by a byte-level convolutional network in numpy.

Bytes are embedded in ``EMBED`` numbers. Filters over ``WIDTH`` bytes move by ``STEP`` bytes along
overlapping chunks that together cover the whole document; each chunk keeps the largest response of
each filter (max-pool). A document is the mean and the maximum of its chunks' pooled responses,
combined by a logistic layer into one probability of label 1. Embedding, filters and the last layer
are learned together by gradient descent; max-pooling sends the gradient back to one window per
chunk and filter, so a step costs little more than scoring.

The network is fitted on the driver over a bounded sample: of the labelled rows that are not held
out, per class the ``SAMPLE`` ids with the smallest hash whose text has at most ``LONGEST_SAMPLED``
bytes, ``SAMPLE_BYTES`` in all. Classes weigh the same. Scoring reads every text whole, some chunks
at a time; neither id, source, language nor label enters a score.

Defined cases: null and empty texts are one chunk without bytes and get a score like others; null
labels and labels other than 0 and 1 are left out; repeated rows are learnt once per distinct text
and label, and scored alike; a null id is the text of no characters; ties do not arise, since equal
texts get equal scores; further columns of the documents are not read, whatever their names; very
long texts are scored whole in bounded memory; without labelled rows of both classes every score is
one half; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import utf8

SAMPLE = 1500
LONGEST_SAMPLED = 16_384
SAMPLE_BYTES = 6_000_000
CUT = 0.3

EMBED = 8
WIDTH = 8
STEP = 2
FILTERS = 32
#: Windows of a chunk. Neighbouring chunks share ``WIDTH - STEP`` bytes, so no window is lost.
WINDOWS = 128
EPOCHS = 8
_STRIDE = WINDOWS * STEP
_CHUNK = _STRIDE + WIDTH - STEP
#: Beyond a text's end; its embedding is zero.
_NONE = 256
_CHUNKS_AT_ONCE = 64
_RATE = 0.01


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    last: np.ndarray | None
    shift: float = 0.0
    scale: float = 1.0


def _fresh() -> Network:
    rng = np.random.default_rng(7)
    embed = rng.normal(0, 1, (257, EMBED)).astype(np.float32)
    embed[_NONE] = 0
    filters = rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32)
    return Network(embed, filters, np.zeros(FILTERS, np.float32), None)


def _in_whole_numbers(net: Network) -> Network:
    """Embedding and filters as whole numbers and one scale.

    No sum of a window's products exceeds 2 ** 24, so single floats hold it exactly in whatever
    order it is taken: equal texts get equal scores wherever they stand.
    """
    most = (1 << 24) // (WIDTH * EMBED * 255)
    embed, filters = np.abs(net.embed).max() / 255, np.abs(net.filters).max() / most
    return replace(net, embed=np.rint(net.embed / embed), filters=np.rint(net.filters / filters), scale=float(embed * filters))


def chunks_of(text: bytes) -> np.ndarray:
    """Overlapping chunks of byte numbers, the last one filled up; one chunk at least."""
    count = max(1, -(-max(0, len(text) - (WIDTH - STEP)) // _STRIDE))
    padded = np.full(count * _STRIDE + WIDTH - STEP, _NONE, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, _CHUNK)[::_STRIDE]


def _pooled(chunks: np.ndarray, net: Network, where: bool = False):
    """Largest response of each filter in each chunk, before the bias; on demand the window it is in."""
    best = np.empty((len(chunks), FILTERS), np.float32)
    at = np.empty((len(chunks), FILTERS), np.int64) if where else None
    for low in range(0, len(chunks), _CHUNKS_AT_ONCE):
        part = chunks[low : low + _CHUNKS_AT_ONCE]
        values = net.embed[part].reshape(len(part), _CHUNK * EMBED)
        windows = np.lib.stride_tricks.sliding_window_view(values, WIDTH * EMBED, axis=1)[:, :: STEP * EMBED]
        response = (windows.reshape(-1, WIDTH * EMBED) @ net.filters).reshape(len(part), WINDOWS, FILTERS)
        if where:
            at[low : low + len(part)] = response.argmax(axis=1)
        best[low : low + len(part)] = response.max(axis=1)
    return best * np.float32(net.scale), at


def _combined(pooled: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean and maximum over each document's chunks."""
    mean = np.add.reduceat(pooled, starts, axis=0) / sizes[:, None]
    return np.concatenate([mean, np.maximum.reduceat(pooled, starts, axis=0)], axis=1)


def _probability(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _bounds(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts])
    return np.cumsum(sizes) - sizes, sizes


def scores_of(texts: list[bytes], net: Network) -> np.ndarray:
    if net.last is None:
        return np.full(len(texts), 0.5)
    parts = [chunks_of(t) for t in texts]
    starts, sizes = _bounds(parts)
    response, _ = _pooled(parts[0] if len(parts) == 1 else np.concatenate(parts), net)
    pooled = np.maximum(response + net.bias, 0)
    return _probability((_combined(pooled, starts, sizes) * net.last).sum(axis=1) + net.shift)


# ---------------------------------------------------------------- fit


class _Adam:
    def __init__(self, value: np.ndarray):
        self.value, self.k = value, 0
        self.mean, self.square = np.zeros_like(value), np.zeros_like(value)

    def step(self, gradient: np.ndarray, rate: float) -> None:
        self.k += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient**2 - self.square)
        down = (self.mean / (1 - 0.9**self.k)) / (np.sqrt(self.square / (1 - 0.999**self.k)) + 1e-8)
        self.value -= (rate * down).astype(self.value.dtype)


def fit_sample(texts: list[bytes], good: list[int], epochs: int = EPOCHS, batch: int = 32) -> Network:
    """Fits the network on labelled texts held in memory."""
    label = np.array(good, float)
    net = _fresh()
    if not len(label) or label.all() or not label.any():
        return net
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    net.last, shift = np.zeros(2 * FILTERS), np.zeros(1)
    learnt = {k: _Adam(v) for k, v in (("embed", net.embed), ("filters", net.filters), ("bias", net.bias), ("last", net.last), ("shift", shift))}
    parts = [chunks_of(t) for t in texts]
    rng = np.random.default_rng(11)
    for epoch in range(epochs):
        rate = _RATE * (1 - epoch / epochs)
        order = rng.permutation(len(parts))
        for low in range(0, len(order), batch):
            own = order[low : low + batch]
            starts, sizes = _bounds([parts[i] for i in own])
            chunks = np.concatenate([parts[i] for i in own])
            response, at = _pooled(chunks, net, where=True)
            pooled = np.maximum(response + net.bias, 0)
            x = _combined(pooled, starts, sizes)
            wrong = weight[own] * (_probability(x @ net.last + shift[0]) - label[own]) / len(own)
            # Back through mean and maximum to the chunks, and from each to one window per filter.
            down = wrong[:, None] * net.last
            document = np.repeat(np.arange(len(own)), sizes)
            back = (down[:, :FILTERS] / sizes[:, None])[document]
            back += np.where(pooled == x[:, FILTERS:][document], down[:, FILTERS:][document], 0)
            back = (back * (pooled > 0)).astype(np.float32)
            byte = np.take_along_axis(chunks[:, None, :], (at * STEP)[:, :, None] + np.arange(WIDTH), axis=2)
            windows = net.embed[byte].reshape(len(chunks), FILTERS, WIDTH * EMBED)
            d_filters = np.einsum("cf,cfw->wf", back, windows)
            d_windows = (back[:, :, None] * net.filters.T[None]).reshape(-1, EMBED)
            d_embed = np.stack([np.bincount(byte.ravel(), d_windows[:, e], minlength=257) for e in range(EMBED)], axis=1)
            d_embed[_NONE] = 0
            for name, gradient in (
                ("last", x.T @ wrong + 1e-4 * net.last), ("shift", np.array([wrong.sum()])),
                ("filters", d_filters), ("bias", back.sum(axis=0)), ("embed", d_embed),
            ):
                learnt[name].step(gradient, rate)
    net.shift = float(shift[0])
    return _in_whole_numbers(net)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learnt from. A null id counts as the text of no characters."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """Fits on the bounded sample of labelled rows that are not held out."""
    learnt = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & ~held_out("id")
    )
    spread = [F.xxhash64("id"), F.col("id")]
    chosen = (
        learnt.filter("label = 1").orderBy(*spread).limit(SAMPLE)
        .unionAll(learnt.filter("label = 0").orderBy(*spread).limit(SAMPLE))
    )
    texts = docs.select(F.col(doc_id).alias("id"), utf8(text).alias("bytes")).filter(F.octet_length("bytes") <= LONGEST_SAMPLED)
    # At most twice the sample, of bounded texts; sorted, for the fit to be the same in every run.
    rows = texts.join(F.broadcast(chosen), "id").select("bytes", "label").distinct().orderBy(F.xxhash64("bytes"), "bytes", "label").limit(2 * SAMPLE)
    bodies, good, size = [], [], 0
    for row in rows.toLocalIterator():
        size += len(row.bytes)
        if size > SAMPLE_BYTES:
            break
        bodies.append(bytes(row.bytes))
        good.append(row.label)
    return fit_sample(bodies, good)


# ---------------------------------------------------------------- scoring

_AT_ONCE_BYTES = 1 << 18


def score_column(docs: DataFrame, net: Network, text: str = "text") -> Column:
    """The probability of label 1 for each text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out, held, size = [], [], 0
            for i in range(len(batch)):
                held.append(batch[i].as_py())
                size += len(held[-1])
                if size > _AT_ONCE_BYTES or i + 1 == len(batch):
                    out.append(scores_of(held, shared.value))
                    held, size = [], 0
            yield pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return scored_texts(utf8(text))


def scored(docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = held.select("doc_id", score_column(held, net).alias("score"))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
