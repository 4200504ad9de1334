"""Quality rules, line dedup, sharding and token counts against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np

from bazarlake.llm import line_dedup, quality_rules, sharding, token_counts
from bazarlake.llm.encoding import tokenizer_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


def test_quality_counts(spark, awkward, empty):
    texts = [r.text for r in awkward.collect()] + ["a b c a b c", "x\nx\n\nx y $%", "# " * 40 + "the end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in quality_rules.measured(docs).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counts(text)
        assert r.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r.kept and r.base_failed)
    accepted = quality_rules.accepted(awkward)
    assert accepted.columns == awkward.columns
    assert accepted.count() == quality_rules.measured(awkward).filter("kept").count()
    assert quality_rules.measured(empty).count() == quality_rules.accepted(empty).count() == 0


def test_quality_rules_tell_junk_from_prose(spark):
    prose = " ".join(f"the{' of' * (i % 3)} matter{i} and thing{i * 7}" for i in range(40))
    docs = [(1, prose), (2, prose.upper()), (3, " ".join(f"w{i}$$$" for i in range(90))), (4, " ".join(f"xq{i}" for i in range(90)))]
    rows = {r.doc_id: r for r in quality_rules.measured(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert rows[1].kept
    assert rows[2].broken_rules == ["shouting_lines"]
    assert rows[3].broken_rules == ["symbols", "stop_words"] and rows[4].broken_rules == ["stop_words"]


def without_repeats(docs):
    """Plain version: documents by id, then text hash order is irrelevant for distinct ids."""
    first, out = {}, {}
    windows = {}
    for i, text in sorted(docs):
        lines = [k for k, line in enumerate(text.split("\n")) if WORD.search(line)]
        parts = text.split("\n")
        windows[i] = [(tuple(parts[k] for k in lines[j : j + 3]), j) for j in range(len(lines) - 2)]
        for w, j in windows[i]:
            first.setdefault(w, (i, j))
    for i, text in docs:
        parts = text.split("\n")
        lines = [k for k, line in enumerate(parts) if WORD.search(line)]
        gone = {lines[j + d] for w, j in windows[i] if first[w] != (i, j) for d in range(3)}
        out[i] = "\n".join(p for k, p in enumerate(parts) if k not in gone)
    return out


def test_line_dedup_against_plain_python(spark):
    rng = np.random.default_rng(3)
    pool = [f"line {i}" for i in range(12)] + ["", "  "]
    docs = [(i, "\n".join(rng.choice(pool, rng.integers(1, 14)))) for i in range(120)]
    docs += [(1000 + i, "hot a\nhot b\nhot c\n" + f"own {i}") for i in range(200)]
    got = {r.doc_id: r for r in line_dedup.report(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()}
    expected = without_repeats(docs)
    assert {i: r.text for i, r in got.items()} == expected
    assert got[1000].n_removed == 0 and got[1001].n_removed == 3 and got[1001].text == "own 1"


def test_line_dedup_of_awkward_rows(awkward, empty):
    rows = line_dedup.report(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].text is None and by_id[2][0].text == "" and by_id[8][0].n_removed == 0
    assert [r.text for r in by_id[9]] == ["line 7 of a passage that is shared between many documents\nand a line of its own"] * 2 or all(
        r.text == "and a line of its own" for r in by_id[9]
    )
    assert by_id[11][0].n_removed == by_id[11][0].n_lines == 8
    cleaned = line_dedup.cleaned(awkward)
    assert cleaned.columns == awkward.columns and 11 not in {r.doc_id for r in cleaned.collect()}
    assert line_dedup.report(empty).count() == line_dedup.cleaned(empty).count() == 0


def test_shards(spark, awkward, empty):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('t', id) AS text").unionByName(awkward.select("doc_id", "text"))
    rows = sharding.sharded(docs.repartition(7)).collect()
    assert len(rows) == 20_015 and {r.law for r in rows} == {"key"}
    assert all(r.grown_shard in (r.shard, 40) for r in rows)
    per_key = {}
    slots = {}
    for r in rows:
        assert per_key.setdefault(r.doc_id, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 40
    mean = len(rows) / 40
    assert sum((len(s) - mean) ** 2 / mean for s in slots.values()) < 80  # chi-square of 39 degrees: beyond by chance once in 5,000
    assert abs(sum(r.grown_shard == 40 for r in rows) / len(rows) - 1 / 41) < 0.01
    own = {(r.doc_id, r.text_crc32): r for r in rows}
    for i, text in [(r.doc_id, r.text) for r in awkward.collect()]:
        data = (text or "").encode()
        assert own[i, zlib.crc32(data)].size == len(data) + 16
    assert sharding.sharded(empty).count() == 0


def jump_of_one(key, shards):
    """The published loop for one key, in whole numbers, after the spreading of neighbouring ids."""
    most = (1 << 64) - 1
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        key = (key ^ key >> shift) * odd & most
    key ^= key >> 31
    shard, ahead = -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * 2862933555777941757 + 1) & most
        ahead = (shard + 1) * (1 << 31) // ((key >> 33) + 1)
    return shard


def test_shards_against_the_scalar_loop(spark):
    ids = [*range(500), -1, -7, (1 << 63) - 1, -(1 << 63), None]
    rows = sharding.sharded(spark.createDataFrame([(i, "x") for i in ids], "doc_id bigint, text string")).collect()
    for r in rows:
        key = sharding._NULL_KEY if r.doc_id is None else r.doc_id & ((1 << 64) - 1)
        assert (r.shard, r.grown_shard) == (jump_of_one(key, 40), jump_of_one(key, 41))
    for n in (1, 2, 3, 1000, 1 << 20):
        keys = np.random.default_rng(n).integers(0, 1 << 64, 300, dtype=np.uint64)
        assert sharding.jump(keys.copy(), n).tolist() == [jump_of_one(int(k), n) for k in keys]


def test_jump_moves_keys_only_into_the_new_shard():
    keys = np.arange(5_000, dtype=np.uint64) * np.uint64(2654435761)
    before = sharding.jump(keys, 1)
    assert not before.any()
    for n in range(2, 60):
        after = sharding.jump(keys, n)
        assert ((after == before) | (after == n - 1)).all()
        before = after


def test_token_counts(spark, awkward, empty, tokenizer):
    library = tokenizer_of(tokenizer)
    odd = ["a  b", " a", "a ", "a \n b", "a  b", "x\x1c y", "<|endoftext|>", "a <|endoftext|> b", "don't  stop 12 34", "　 x"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string").unionByName(awkward.select("doc_id", "text"))
    texts = sorted((r.text or "") for r in docs.collect())
    want = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts)
    rows = token_counts.counted(docs.repartition(40), tokenizer).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    assert token_counts.counted(empty, tokenizer).count() == 0
