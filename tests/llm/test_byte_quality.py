"""The byte network: chunks and pooling against a plain version, the fit, held-out accuracy."""

import zlib

import numpy as np

import __spark_entry__ as entry
from bazarlake.llm import byte_quality as b

SMALL = "/root/testdata/sf0.01"


def plain_score(text, net):
    """Every window of the whole text, one by one; chunks only group the windows."""
    count = max(1, -(-max(0, len(text) - (b.WIDTH - b.STEP)) // (b.WINDOWS * b.STEP)))
    padded = list(text) + [b._NONE] * (count * b.WINDOWS * b.STEP + b.WIDTH - b.STEP - len(text))
    pooled = []
    for c in range(count):
        best = np.full(b.FILTERS, -np.inf)
        for w in range(b.WINDOWS):
            at = (c * b.WINDOWS + w) * b.STEP
            best = np.maximum(best, net.embed[padded[at : at + b.WIDTH]].ravel() @ net.filters * net.scale)
        pooled.append(np.maximum(best + net.bias, 0))
    x = np.concatenate([np.mean(pooled, axis=0), np.max(pooled, axis=0)])
    return 1 / (1 + np.exp(-(x @ net.last + net.shift)))


def fitted():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, int(n)).tolist()) for n in rng.integers(2, 9, 300)]
    prose = [b" ".join(words[i] for i in rng.integers(0, 300, 80)) for _ in range(60)]
    junk = [b"## ".join(words[i] for i in rng.integers(0, 300, 80)) for _ in range(60)]
    return prose, junk, b.fit_sample(prose + junk, [1] * 60 + [0] * 60)


def test_scores_against_plain_windows():
    prose, junk, net = fitted()
    long = b" ".join(prose) + junk[0]
    texts = [b"", b"a", prose[0], junk[0], long, prose[1] * 3, b"x" * (b._CHUNK - 1), b"x" * b._CHUNK, b"x" * (b._CHUNK + 1), long]
    got = b.scores_of(texts, net)
    assert np.allclose(got, [plain_score(t, net) for t in texts], atol=1e-4)
    assert (b.scores_of(prose, net) == np.concatenate([b.scores_of([t], net) for t in prose])).all()  # to the last bit
    assert (b.scores_of(prose, net) > 0.5).mean() > 0.95 and (b.scores_of(junk, net) < 0.5).mean() > 0.95
    # The last bytes of a long text count: the junk there lies in no prefix.
    assert abs(b.scores_of([b" ".join(prose)], net)[0] - got[4]) > 1e-6


def test_fit_goes_down_and_needs_both_classes():
    prose, junk, net = fitted()
    early = b.fit_sample(prose + junk, [1] * 60 + [0] * 60, epochs=1)

    def loss(n):
        return -np.log(np.concatenate([b.scores_of(prose, n), 1 - b.scores_of(junk, n)])).mean()

    assert loss(net) < loss(early)
    assert loss(b.fit_sample(prose + junk, [1] * 60 + [0] * 60, epochs=16)) < 0.05
    assert set(b.scores_of([b"", b"x"], b.fit_sample([b"x"], [1])).tolist()) == {0.5}
    assert set(b.scores_of([b"", b"x"], b.fit_sample([], [])).tolist()) == {0.5}


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, None), (7, 3), (8, 1), (None, 0), (11, 0)], "doc_id bigint, quality int")
    rows = b.scored(awkward, b.fit(awkward, labels)).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r.score)
    assert by_id[6] == by_id[7] and len(set(by_id[9])) == 1
    assert by_id[1] == by_id[2]  # null and empty
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in rows)
    assert b.scored(empty, b.fit(empty, labels)).count() == b.scored(empty, b.fit(awkward, labels.limit(0))).count() == 0


def test_query_tells_held_out_labels(spark):
    frame = entry.queries()["op12_byte_quality"](spark, SMALL)
    assert frame.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = frame.collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([a == p for a, p in judged]) > 0.9
    assert np.mean([p for a, p in judged if a == 1]) > 0.95
