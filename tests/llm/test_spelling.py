"""Spelling variants against a plain version over deletion neighbourhoods."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from bazarlake.llm import spelling

SMALL = "/root/testdata/sf0.001"


def counted(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = defaultdict(set)
    cuts = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cuts[w[:i] + w[i + 1 :]].add(w)
        cuts[w].add(w)
    for group in cuts.values():
        for a in group:
            near[a].update(b for b in group if one_apart(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def rows_of(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


@pytest.mark.parametrize("crowded", [2, 7, 1024])
def test_near_words_against_brute_force(spark, crowded):
    rng = np.random.default_rng(crowded)
    words = {}
    for size in (7, 8, 9, 12):
        for _ in range(120):
            words["".join(rng.choice(list("abé"), size))] = int(rng.integers(2, 9))
    hot = "prefixprefix"  # everything around one word: keys that stay crowded down to a letter
    for i in range(len(hot) + 1):
        for letter in "abcdefghijklmnopqrstuvwxyzß":
            words[hot[:i] + letter + hot[i:]] = 3
            words[hot[:i] + letter + hot[i + 1 :]] = 40
    words |= {hot: 4000, "aaaaaaaa": 5, "aaaaaaaaa": 50, "aaaaaaaaaa": 500, "aaaaaaaaaaa": 5000, "z" * 3000: 2, "z" * 3001: 20, "z" * 2999 + "y": 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert rows_of(spelling.grouped(frame, crowded=crowded)) == brute(words)


def test_vocabulary_of_awkward_rows(spark, awkward, empty):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    found = {r.word: r.n for r in spelling.word_counts(awkward).collect()}
    assert found == counted(docs)
    assert rows_of(spelling.variants(awkward)) == brute(counted(docs))
    assert spelling.variants(empty).count() == 0
    long = [(1, "Überschwänglich ÜBERSCHWÄNGLICH×÷ " * 60_000), (2, "a" * 100_000 + " " + "a" * 100_000)]
    found = {r.word: r.n for r in spelling.word_counts(spark.createDataFrame(long, "doc_id bigint, text string")).collect()}
    assert found == counted(long)


def test_query_over_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    frame = entry.queries()["op11_spelling_variants"](spark, SMALL)
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(counted(docs))
    assert rows_of(frame) == want
    assert any(x[0] for x in want.values())
