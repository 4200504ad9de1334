"""The segmentation does no work twice: agendas behind the branch, ids spelled by arrays, words looked up once."""

import numpy as np
import public_tokenizers
import pytest

from bazarlake.llm import segmentation
from bazarlake.llm.segmentation import Lattice, Trie, Vocabulary, sample_texts

TEXTS = ["a lake of olist orders", "", "naïve  ▁ 🙂 text", "x", "the the the lake", " lead", "trail "]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def test_agendas_begin_at_the_branch(vocabulary, monkeypatch):
    seen, fill = [], segmentation._fill_agendas

    def watched(walker, documents, sample):
        fill(walker, documents, sample)
        seen.extend((sample, d.paths[-1]) for d in documents)

    monkeypatch.setattr(segmentation, "_fill_agendas", watched)
    sample_texts(TEXTS * 3, np.arange(1, 3 * len(TEXTS) + 1, dtype=np.uint64), 4, Trie(vocabulary), vocabulary)
    assert any(p.branch for _, p in seen)
    for sample, path in seen:
        assert len(path.agenda) == len(path.edges) - path.branch
        assert path.branch == 0 if sample == 0 else path.top[1] >= path.branch or path.top[0] == -np.inf


def test_ids_decode_to_their_spellings(vocabulary):
    rng = np.random.default_rng(7)
    for size in (0, 1, 2, 50):
        ids = rng.integers(0, len(vocabulary.spelling), size).astype("<u4")
        assert vocabulary.decode(ids) == b"".join(vocabulary.spelling[i] for i in ids.tolist())[1:]
    assert len(vocabulary.bytes) == sum(map(len, vocabulary.spelling))


def test_known_words_are_not_added_again(vocabulary, monkeypatch):
    walker, added = Lattice(Trie(vocabulary), vocabulary), []
    monkeypatch.setattr(walker, "_add", lambda words, add=walker._add: (added.append(list(words)), add(words)))
    first = walker.places(["lake", "order", "lake"])
    assert first[0] == first[2] != first[1] and added == [["lake", "order"]]
    again = walker.places(["order", "new", "lake", "new"])
    assert added[1:] == [["new"]] and again[0] == first[1] and again[2] == first[0] and again[1] == again[3]
    assert walker.places([]).tolist() == [] and len(added) == 2
