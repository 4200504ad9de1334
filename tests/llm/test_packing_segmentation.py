"""Both packings and the sampled segmentations: exact round trips and exact probabilities."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from bazarlake.llm import cost_packing, matrix_packing, segmentation
from bazarlake.llm.encoding import tokenizer_of


def check_cover(pieces, lengths):
    at = {}
    for document, start, length in sorted(pieces):
        assert start == at.get(document, 0) and length > 0
        at[document] = start + length
    assert at == {d: n for d, n in enumerate(lengths) if n}


def test_cost_packing_places_every_token_once_without_padding():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 40, 900):
        lengths = [int(x) for x in rng.choice([1, 2, 7, 300, 512, 1023, 1024, 1025, 5000], n)]
        pieces = cost_packing.pack(lengths)
        check_cover([(p.document, p.start, p.length) for p in pieces], lengths)
        rows = {}
        for p in pieces:
            rows.setdefault(p.sequence, []).append((p.offset, p.length))
        for row in rows.values():
            end = 0
            for offset, length in sorted(row):
                assert offset == end
                end += length
            assert end <= 1024 and end & (end - 1) == 0
        assert sorted(rows) == list(range(len(rows)))


def test_costs_are_balanced():
    lengths = [int(x) for x in np.random.default_rng(2).integers(10, 300, 2000)]
    rows, tokens = Counter(), Counter()
    for p in cost_packing.pack(lengths):
        rows[p.sequence] += p.length + p.length**2 / 1024
        tokens[p.sequence] += p.length
    # The short sequences of power-of-two lengths at the end are cheaper by design.
    costs = np.array([rows[s] for s in rows if tokens[s] == 1024])
    assert len(costs) >= len(rows) - 10 and costs.std() < 0.08 * costs.mean()


def test_dearer_sequences_are_found_behind_many_full_ones():
    rng = np.random.default_rng(3)
    lengths = [401] * 700 + [int(x) for x in rng.integers(1, 1024, 1400)]
    pieces = cost_packing.pack(lengths)
    check_cover([(p.document, p.start, p.length) for p in pieces], lengths)
    bins, rest = divmod(sum(lengths), 1024)
    room = [1024] * bins + [1 << b for b in reversed(range(11)) if rest >> b & 1]
    cost, cut, whole = [0.0] * len(room), set(), []
    for d in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        n = lengths[d]
        fits = [b for b in range(bins) if room[b] >= n] or [b for b in range(bins, len(room)) if room[b] >= n]
        if fits:
            b = min(fits, key=lambda b: cost[b])
            room[b] -= n
            cost[b] += n + n * n / 1024
            whole.append(cost[b])
        else:
            cut.add(d)
    parts = Counter(p.document for p in pieces)
    assert {d for d, n in parts.items() if n > 1} <= cut and len(parts) - len(cut) == len(whole)


def test_packed_rows(awkward, empty, tokenizer):
    library = tokenizer_of(tokenizer)
    rows = cost_packing.packed(awkward, tokenizer, group_tokens=50_000).collect()
    pieces, sequences = {}, {}
    for r in rows:
        assert zlib.crc32(bytes(r.token_ids)) == r.ids_crc32 and len(r.token_ids) == 4 * r.length
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.token_ids, "<u4").tolist()))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for row in sequences.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(row), sorted(row)[1:], strict=False)) and min(row)[0] == 0
    for r in awkward.filter("doc_id IN (1, 2, 6, 8, 10)").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert sum((part for _, part in sorted(pieces[r.doc_id, len(ids)])), []) == ids
    assert cost_packing.packed(empty, tokenizer).count() == 0


def test_best_fit_against_a_plain_search():
    lengths = [int(x) for x in np.random.default_rng(4).integers(1, 2500, 400)]
    rows = matrix_packing.best_fit(lengths, 1000)
    check_cover([p for row in rows for p in row], lengths)
    plain = []
    for length in sorted((min(1000, n - s) for n in lengths for s in range(0, n, 1000)), reverse=True):
        fits = [i for i, room in enumerate(plain) if room >= length]
        if fits:
            plain[min(fits, key=lambda i: plain[i])] -= length
        else:
            plain.append(1000 - length)
    assert len(rows) == len(plain)
    assert sorted(1000 - sum(n for _, _, n in row) for row in rows) == sorted(plain)


def test_matrix_round_trip(awkward, empty, tokenizer):
    library = tokenizer_of(tokenizer)
    rows = matrix_packing.packed(awkward, tokenizer, capacity=512, group_tokens=40_000)
    for r in rows.collect():
        position = np.frombuffer(r.position_ids, "<u2")
        assert len(position) == 512 and len(r.input_ids) == 1024 and r.cu_seqlens[-1] == r.n_tokens
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert position[a:b].tolist() == list(range(b - a))
    found = {}
    for r in matrix_packing.unpacked(rows).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.ids))
    for r in awkward.filter("doc_id IN (1, 4, 7, 11)").collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids + [matrix_packing.END_ID]
        assert sum((ids for _, ids in sorted(found[r.doc_id])), []) == want
    assert matrix_packing.packed(empty, tokenizer).count() == 0


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def all_paths(vocabulary, text):
    full, out = "▁" + text.replace(" ", "▁"), {}

    def go(i, ids, weight):
        if i == len(full):
            out[tuple(ids)] = weight
        for j in range(i + 1, len(full) + 1):
            if found := vocabulary.weight.get(full[i:j]):
                go(j, [*ids, found[0]], weight + found[1])
            elif j == i + 1:
                spelled = [vocabulary.byte[b] for b in full[i].encode()]
                go(j, ids + spelled, weight + len(spelled) * vocabulary.byte_weight)

    go(0, [], 0.0)
    total = math.log(sum(map(math.exp, out.values())))
    return {ids: w - total for ids, w in out.items()}


def test_samples_are_distinct_and_have_their_probability():
    vocabulary = segmentation.Vocabulary(MODEL, power=0.15)
    trie, text, n = segmentation.Trie(vocabulary), "the ab\n", 6000
    paths = all_paths(vocabulary, text)
    keys = segmentation._hash(np.arange(n, dtype=np.uint64))
    found = segmentation.sample_texts([text] * n, keys, 3, trie, vocabulary)
    drawn = [[tuple(p["ids"].tolist()) for p in row] for row in found]
    assert all(len(set(d)) == 3 for d in drawn)
    assert all(abs(p["log_prob"] - paths[tuple(p["ids"].tolist())]) < 1e-9 for row in found for p in row)
    assert all(a["perturbed"] > b["perturbed"] for row in found for a, b in zip(row, row[1:], strict=False))
    first, second = Counter(d[0] for d in drawn), Counter(d[1] for d in drawn)
    p = {ids: math.exp(w) for ids, w in paths.items()}
    for ids in sorted(p, key=p.get)[-8:]:
        assert abs(first[ids] / n - p[ids]) < 4 * math.sqrt(p[ids] / n)
        want = sum(p[a] * p[ids] / (1 - p[a]) for a in p if a != ids)
        assert abs(second[ids] / n - want) < 4 * math.sqrt(want / n)
    estimate = np.mean([sum(math.exp(x["log_prob"]) / x["inclusion"] for x in row) for row in found])
    assert abs(estimate - 1) < 0.03


def test_all_paths_of_a_small_lattice_are_found():
    vocabulary = segmentation.Vocabulary(MODEL)
    paths = all_paths(vocabulary, "aé")
    (found,) = segmentation.sample_texts(["aé"], np.array([3], np.uint64), 100, segmentation.Trie(vocabulary), vocabulary)
    assert {tuple(p["ids"].tolist()) for p in found} == set(paths)
    assert all(p["inclusion"] == 1.0 for p in found)


def forward(vocabulary, full):
    """log of the summed weights of all paths."""
    total = [0.0] + [-math.inf] * len(full)
    for j in range(1, len(full) + 1):
        ends = [total[i] + vocabulary.weight[full[i:j]][1] for i in range(max(0, j - vocabulary.longest), j) if full[i:j] in vocabulary.weight]
        if full[j - 1] not in vocabulary.weight:
            ends.append(total[j - 1] + len(full[j - 1].encode()) * vocabulary.byte_weight)
        total[j] = np.logaddexp.reduce(ends)
    return total[-1]


def test_a_long_run_has_its_whole_lattice():
    vocabulary = segmentation.Vocabulary(MODEL, power=0.05)
    trie, bare = segmentation.Trie(vocabulary), chr(0x13000)
    assert bare not in vocabulary.weight and "th" in vocabulary.weight
    text = bare * 62 + "th" + bare * 3 + "th"
    paths = all_paths(vocabulary, text)
    (found,) = segmentation.sample_texts([text], np.array([3], np.uint64), 1000, trie, vocabulary)
    assert {tuple(p["ids"].tolist()) for p in found} == set(paths)
    assert all(abs(p["log_prob"] - paths[tuple(p["ids"].tolist())]) < 1e-9 for p in found)
    text = "".join(np.random.default_rng(9).choice(list("etaoinshr\n東é"), 700)) + " " * 90 + "a" * 200
    weight = dict(vocabulary.weight.values()) | dict.fromkeys(vocabulary.byte.values(), vocabulary.byte_weight)
    z = forward(vocabulary, "▁" + text.replace(" ", "▁"))
    (found,) = segmentation.sample_texts([text], np.array([5], np.uint64), 3, trie, vocabulary)
    for p in found:
        assert vocabulary.decode(p["ids"]).decode() == text
        assert abs(p["log_prob"] - (sum(weight[i] for i in p["ids"].tolist()) - z)) < 1e-6


def test_segmentation_rows(awkward, empty):
    rows = segmentation.sampled(awkward, MODEL).collect()
    assert all(r.round_trip for r in rows)
    blank = [r for r in rows if r.doc_id in (1, 2)]
    assert [(r.n_pieces, r.log_prob, r.inclusion) for r in blank] == [(0, 0.0, 1.0)] * 2
    again = segmentation.sampled(awkward.repartition(3), MODEL).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert segmentation.sampled(empty, MODEL).count() == 0


def test_the_sign_for_a_space_is_spelled_in_bytes():
    vocabulary = segmentation.Vocabulary(MODEL)
    trie = segmentation.Trie(vocabulary)
    for text in ("a▁b x", "▁", " ▁▁ a", "a  ▁", "\n▁a"):
        (found,) = segmentation.sample_texts([text], np.array([7], np.uint64), 3, trie, vocabulary)
        assert found
        assert all(vocabulary.decode(p["ids"]).decode() == text for p in found)


def test_samples_do_not_depend_on_the_words_met_before(monkeypatch):
    vocabulary = segmentation.Vocabulary(MODEL)
    trie = segmentation.Trie(vocabulary)
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("etaoin東é\n"), rng.integers(1, 14))) for _ in range(400)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(30)]
    keys = segmentation._hash(np.arange(30, dtype=np.uint64))
    alone = [segmentation.sample_texts([t], keys[i : i + 1], 3, trie, vocabulary)[0] for i, t in enumerate(texts)]
    monkeypatch.setattr(segmentation, "_KEPT_BYTES", 100_000)
    walker = segmentation.Lattice(trie, vocabulary)
    for low in range(0, 30, 5):
        found = segmentation.sample_texts(texts[low : low + 5], keys[low : low + 5], 3, trie, vocabulary, walker)
        assert str(found) == str(alone[low : low + 5])
        walker.forget()
        assert walker.nbytes <= 100_000 and len(walker.known) == len(walker.first)
