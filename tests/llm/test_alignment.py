"""Alignment against a plain version: whole texts by the libraries, every pair of tokens compared."""

import bisect
import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from bazarlake.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


def spans(ids, size_of):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + size_of(i)))
        at += size_of(i)
    return out


def brute(docs):
    words = alignment.Vocabularies(A, B)
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    texts = []
    for doc_id, text in docs:
        a, b, whole = [], [], (" " + (text or "")).encode()
        if text:
            a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        if not text or b"".join(words.a_bytes[i] for i in a) != whole or b"".join(words.b_bytes[i] for i in b) != whole:
            a = b = []
        sa, sb = spans(a, lambda i: len(words.a_bytes[i])), spans(b, lambda i: len(words.b_bytes[i]))
        cuts = sorted({e for *_, e in sa} & {e for *_, e in sb})
        parts = [([], []) for _ in cuts]
        for side, tokens in enumerate((sa, sb)):
            for i, _, e in tokens:
                parts[bisect.bisect_left(cuts, e)][side].append(str(i))
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in parts]
        links = Counter()
        near = 0
        for i, s, e in sa:
            while near and near < len(sb) and sb[near][1] >= s:
                near -= 1
            k = near
            while k < len(sb) and sb[k][1] < e:
                if sb[k][2] > s:
                    links[i, sb[k][0]] += 1
                k += 1
            near = max(0, k - 1)
        texts.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    held = Counter(pair for *_, links, _ in texts for pair in links)
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return sorted(
        (str(d), na, nb, ng, sum(links.values()), sum(t for p, t in links.items() if held[p] == best[p[0]]), sum(t * held[p] for p, t in links.items()), sha)
        for d, na, nb, ng, links, sha in texts
    )


def rows_of(frame):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect())


@pytest.fixture(scope="module")
def odd(spark):
    texts = [
        "plain words only", "two  spaces and   three", " leading", "trailing ", "  ", " ", "tab\tand\nline\n\n feeds \n x", "a▁b", "▁", "<|endoftext|> <s></s> <unk>x",
        "Zürich 東京 ﬁ ½ é  nbsp  em", "naïve façade 😀😀 👩‍👩‍👧", "x" * 500 + " " + "ab" * 300, "don't we'll I'm 1234567 3.14 !!! ???", "\x00\x01 nul", "𝔘𝔫𝔦 ​ zero",
        "aaaa aa aaaaaaaa a", "\u0085next line", "   sep", "of the of the of the",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (0, texts[0]), (None, texts[1]), (None, None)]
    rows += [(200 + i, "of the common words " * 3 + str(i)) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)


@pytest.mark.parametrize("shared", [5, 200_000])
def test_against_brute_force(odd, shared):
    want = brute([(r.doc_id, r.text) for r in odd.collect()])
    assert rows_of(alignment.report(odd, A, B, shared=shared)) == want
    assert sum(1 for r in want if r[1]) > 50


def test_awkward_rows_and_small_caches(awkward, empty, monkeypatch):
    monkeypatch.setattr(alignment, "_CACHED_CHUNKS", 50)
    want = brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert rows_of(alignment.report(awkward, A, B)) == want
    assert alignment.report(empty, A, B).count() == 0


def test_forgetting_changes_nothing(odd):
    texts = [r.text or "" for r in odd.collect()]
    whole = alignment.Aligner(alignment.Vocabularies(A, B))
    want = whole.align(texts)
    for text, figures, digest in zip(texts, want[0].tolist(), want[1], strict=True):
        whole.forget()
        got = whole.align([text])
        assert got[0][0].tolist() == figures and got[1] == [digest]


def test_query_over_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    frame = entry.queries()["op13_token_alignment"](spark, SMALL)
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(frame) == brute(docs)
