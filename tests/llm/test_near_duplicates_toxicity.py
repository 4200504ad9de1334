"""MinHash and NN-descent against brute force, the field against enumeration, and the pipeline."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from bazarlake.llm import components, minhash, nn_descent, toxicity
from bazarlake.llm.queries import QUERIES
from compare import connect, difference

SMALL = "/root/testdata/sf0.001"


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(docs, width, percent):
    sets = {i: shingles(t, width) for i, t in docs}
    groups = Groups(sets)
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            groups.join(a, b)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_minhash_against_brute_force(spark, width, percent):
    rng = np.random.default_rng(width)
    base = [f"w{i}" for i in rng.integers(0, 400, 150)]
    docs = [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "one two")]
    for i in range(5, 220):  # a large group of copies with more and more edits, none of them the original
        words = list(base)
        for at in rng.choice(150, i // 24, replace=False):
            words[at] = f"e{i}" if i % 3 else "shared"
        docs.append((i, " ".join(words)))
    docs += [(i, " ".join(f"x{k}" for k in rng.integers(0, 5000, 60))) for i in range(300, 340)]
    docs += [(i, docs[7][1]) for i in range(400, 460)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    rows = minhash.report(frame, width=width, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, width, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_minhash_of_awkward_rows(awkward, empty):
    rows = minhash.report(awkward).collect()
    assert len(rows) == awkward.count()
    of = {r.doc_id: r.component_id for r in rows}
    assert of[1] == 1 and of[2] == 2 and of[7] == 6 and of[11] == 8
    one = minhash.one_of_each(awkward)
    assert one.columns == awkward.columns
    ids = [r.doc_id for r in one.collect()]
    assert ids.count(8) == 1 and ids.count(11) == 0 and ids.count(7) == 0 and ids.count(9) <= 1
    assert minhash.report(empty).count() == minhash.one_of_each(empty).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(1000, 1200)] + [(3, 3), (None, 1)]
    rows = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    of = {r.node: r.component for r in rows}
    assert {of[i] for i in range(100, 141)} == {100} and {of[i] for i in range(1000, 1200)} == {7} and of[3] == 3
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def cosine_links(rows):
    out = {}
    for i, v, label in rows:
        good = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        u = np.array(v, float) / np.linalg.norm(v) if good else None
        out[i] = (u, label)
    groups, links = Groups(out), dict.fromkeys(out, 0)
    for a, b in itertools.combinations(out, 2):
        (u, x), (v, y) = out[a], out[b]
        if u is not None and v is not None and x == y and len(u) == len(v) and u @ v >= 0.93:
            groups.join(a, b)
            links[a] += 1
            links[b] += 1
    return {i: (links[i], groups.find(i)) for i in out}


def test_nn_descent_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(24).tolist(), i % 3) for i in range(300)]
    rows += [(1000 + i, [x + 0.1 * e for x, e in zip(rows[i][1], rng.standard_normal(24).tolist(), strict=True)], i % 3) for i in range(60)]
    center = rng.standard_normal(24)
    rows += [(2000 + i, (center + (0.05 + 0.002 * i) * rng.standard_normal(24)).tolist(), 1) for i in range(150)]  # wider than a ball
    rows += [(3000 + i, rows[5][1], 2) for i in range(70)]
    bad = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0]]
    rows += [(4000 + i, v, 1) for i, v in enumerate(bad)] + [(5000, rows[0][1], None)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    found = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(frame).collect()}
    want = cosine_links(rows)
    assert found.keys() == want.keys()
    total = sum(n for n, _ in want.values())
    assert sum(n for n, _ in found.values()) >= 0.98 * total
    assert all(found[i][0] <= want[i][0] for i in want)
    assert np.mean([found[i] == want[i] for i in want]) > 0.97
    assert nn_descent.linked(frame.limit(0)).count() == 0


def test_full_families_that_link_across(spark):
    rng = np.random.default_rng(12)
    rows, n = [], 0
    for angle, shift in ((0.33, 0.0), (0.52, 0.09)):  # linked by their middles; by every tenth member alone
        a, b = np.linalg.qr(rng.standard_normal((48, 2)))[0].T
        b = math.cos(angle) * a + math.sin(angle) * b
        for center, other in ((a, b), (b, a)):
            for i in range(75):
                moved = center + (shift / angle if i % 10 == 0 else 0.0) * (other - center)
                rows.append((n, (moved + 0.004 * rng.standard_normal(48)).tolist(), 1))
                n += 1
    rows += [(5000 + i, rng.standard_normal(48).tolist(), 1) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    want = cosine_links(rows)
    assert {want[i][1] for i in range(150)} == {0} and {want[i][1] for i in range(150, n)} == {150}
    assert {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(frame).collect()} == want


def test_missed_links_beside_a_hot_group_are_noticed(spark, monkeypatch):
    rng = np.random.default_rng(14)
    center = rng.standard_normal(24)
    rows = [(i, (center + 0.01 * rng.standard_normal(24)).tolist(), 1) for i in range(60)]
    for i in range(40):
        v = rng.standard_normal(24)
        rows += [(100 + 2 * i + k, (v + 0.05 * rng.standard_normal(24)).tolist(), 1) for k in range(2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(2)
    want = cosine_links(rows)
    turns, start = [], nn_descent._start

    def poor(classes, keep, turn):  # knows the hot group alone
        turns.append(turn)
        hot = classes.filter("least < 100").select("cid")
        return start(classes, keep, turn).join(hot, F.col("u") == F.col("cid"), "left_semi").join(hot, F.col("v") == F.col("cid"), "left_semi")

    monkeypatch.setattr(nn_descent, "_start", poor)
    monkeypatch.setattr(nn_descent, "PASSES", 2)
    assert {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.linked(frame).collect()} == want
    assert turns == [0, 1]


def test_hyperplanes_differ_by_turn():
    units = np.random.default_rng(15).standard_normal((50, 24))
    assert not (nn_descent._codes(units, 8, 0) == nn_descent._codes(units, 8, 1)).any()


def test_chain_against_enumeration():
    rng = np.random.default_rng(8)
    emission, transition = rng.standard_normal(9), rng.standard_normal((2, 2))
    sizes = np.array([4, 0, 5])
    marginal, pairs = toxicity._forward_backward(emission, sizes, transition)
    at, total = 0, np.zeros((2, 2))
    for n in (4, 5):
        e, weights = emission[at : at + n], {}
        for y in itertools.product((0, 1), repeat=n):
            weights[y] = math.exp(sum(x for x, s in zip(e, y, strict=True) if s) + sum(transition[a, b] for a, b in zip(y, y[1:], strict=False)))
        z = sum(weights.values())
        for t in range(n):
            assert abs(marginal[at + t] - sum(w for y, w in weights.items() if y[t]) / z) < 1e-9
        for y, w in weights.items():
            for a, b in zip(y, y[1:], strict=False):
                total[a, b] += w / z
        at += n
    assert np.allclose(pairs, total)


@pytest.fixture(scope="module")
def prose(spark):
    rng = np.random.default_rng(6)
    words = [f"{a}{b}" for a in ("ner", "tal", "mio", "ras", "vel") for b in ("en", "ak", "is", "orn", "und")]
    docs, labels = [], []
    for i in range(600):
        text = list(rng.choice(words, 60))
        if toxic := int(i % 4 == 0):
            for at in rng.choice(60, 3, replace=False):
                text[at] = str(rng.choice(["scumbag", "moronic", "trashy"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_of_held_out_documents(prose, awkward, empty):
    docs, labels = prose
    model = toxicity.fit(docs, labels)
    rows = toxicity.scored(docs, model).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and all(r.predicted == r.toxic for r in rows)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        for span in r.spans:
            assert any(w in ("scumbag", "moronic", "trashy") for w in text[r.doc_id][span.start : span.stop].split(" "))
    assert toxicity.clean_rows(docs, model).count() == 450
    odd = toxicity.scored(awkward, model).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score < 0.7 for r in odd)
    assert toxicity.clean_rows(awkward, model).columns == awkward.columns
    assert toxicity.scored(empty, model).count() == 0
    assert toxicity.fit(docs, labels.limit(0)).document is None


def test_no_label_of_held_out_rows_is_learnt(prose):
    docs, labels = prose
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.document, b.document)


def test_pipeline_stages_keep_columns_and_rows_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL).cache()
        assert out.columns == columns and out.count() <= docs.count(), name
        docs = out
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_expected_results(spark):
    duck = connect(SMALL)
    for name in sorted(set(entry.oracle_sql()) & set(QUERIES)):
        assert difference(QUERIES[name](spark, SMALL), duck, entry.oracle_sql()[name]) is None, name
