"""Distinct sampled segmentations of a text: Gumbel top-k without replacement over the lattice.

The lattice of a text has all ways to write it in pieces of a SentencePiece vocabulary, with bytes
for characters that have no piece. A path's weight is the product of its pieces' weights,
``(rank + 2) ** -POWER``; divided by the sum over all paths it is a probability. Perturbing every
path's log-probability with Gumbel noise and taking the k largest gives k *different* paths, as if
drawn one after the other without replacement. They are found best-first, as in A*: the agenda
holds sets of paths (all that leave a known path at one node by another piece), each with the exact
perturbed value of its best member, which is sampled from the set's total weight. Opening a set
walks down to that member and adds the sets beside its way. An inclusion score is the probability
that the path's noise exceeds the (k+1)-th value: ``1 - exp(-exp(log_prob - threshold))``.

No piece crosses a space, so the lattice falls into words. The distinct words of a batch of texts
are built together, by the number of characters left, and all words take a step together; a worker
keeps the lattices of words from earlier batches and tasks up to a stated number of bytes. Memory
follows the batch, or the longest text if that is longer. Noise is hashed from the row's key, the
sample and the place in the text, so a row's samples depend on nothing else and repeat in every run.

A run without a space, however long, is one word, and its lattice is whole; the steps of a batch
follow its longest word. A text's own U+2581, the vocabulary's sign for a space, is spelled in bytes,
so that every path decodes to the text itself.

Defined cases: a null or empty text has one path of no pieces, with log-probability 0 and score 1; a
text with fewer paths than asked for gives all of them, each with score 1; rows that repeat a key
get the same noise; a null key counts as the text of no characters; an empty table gives an
empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import text_or_empty
from bazarlake.llm.encoding import in_groups

SAMPLES = 3
POWER = 1.0
_SPACE = "▁"
_WORDS = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")
#: Stands for U+2581 of the text itself: half of a surrogate pair, which no text holds.
_OWN = "\ud800"
_BATCH_CHARS = 3 << 19
#: Bytes of word lattices that a worker keeps between batches.
_KEPT_BYTES = 128 << 20
_WORD_BYTES = 150
#: Characters below this, and the space, have a column of their own in the trie.
_COMMON = 128
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP, _WORD, _SAMPLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def _hash(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1."""
    return ((_hash(x) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


class Vocabulary:
    """Ids, weights and bytes of a SentencePiece model's pieces."""

    def __init__(self, path: str, power: float = POWER):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.weight: dict[str, tuple[int, float]] = {}
        self.byte: dict[int, int] = {}
        self.spelling: list[bytes] = []
        size = model.vocab_size()
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.spelling.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelling.append(b"")
            else:
                if _SPACE in piece[1:] and piece.strip(_SPACE):
                    raise ValueError(f"piece {piece!r} crosses a space")
                self.weight[piece] = (i, -power * float(np.log(2.0 - max(model.get_score(i), -size))))
                self.spelling.append(piece.replace(_SPACE, " ").encode())
        self.byte_weight = -power * float(np.log(2.0 + size)) - 1.0
        self.longest = max(map(len, self.weight))
        self.bytes = np.frombuffer(b"".join(self.spelling), np.uint8)  # of all ids, one after the other
        self.width = np.array([len(x) for x in self.spelling], np.int64)
        self.begin = np.cumsum(self.width) - self.width

    def in_bytes(self, pieces: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Ids of paths of ``sizes`` pieces each, with the bytes' ids for the characters (numbered
        from the vocabulary's size) without a piece."""
        size = len(self.spelling)
        bare = np.flatnonzero(pieces >= size)
        width = np.ones(len(pieces), np.int64)
        chars, which = np.unique(pieces[bare] - size, return_inverse=True)
        spelled = [(_SPACE if chr(c) == _OWN else chr(c)).encode() for c in chars.tolist()]
        width[bare] = np.array([len(x) for x in spelled], np.int64)[which]
        ends = np.cumsum(width)
        out = np.repeat(pieces, width).astype("<u4")
        begins = ends[bare] - width[bare]
        for i in range(4):
            at = width[bare] > i
            ids = np.array([self.byte[x[i]] if len(x) > i else 0 for x in spelled], np.int64)
            out[begins[at] + i] = ids[which[at]]
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [out[low:high] for low, high in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids; the first space is the encoder's own."""
        width = self.width[ids]
        place = np.repeat(self.begin[ids] - np.cumsum(width) + width, width)
        place += np.arange(len(place))
        return self.bytes[place[1:]].tobytes()


class Trie:
    """Which pieces begin at each place of many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        after: dict[int, int] = {}
        piece, weight = [-1], [0.0]
        for spelling, (i, w) in vocabulary.weight.items():
            node = 0
            for char in spelling:
                key = node << 21 | ord(char)
                if key not in after:
                    after[key] = len(piece)
                    piece.append(-1)
                    weight.append(0.0)
                node = after[key]
            piece[node], weight[node] = i, w
        self.keys = np.array(sorted(after), np.int64)
        self.nodes = np.array([after[k] for k in self.keys.tolist()], np.int64)
        self.piece, self.weight = np.array(piece), np.array(weight)
        # The steps by common characters as a table; a node without a step has the last row.
        inner = np.unique(self.keys >> 21)
        self.row = np.full(len(piece), len(inner))
        self.row[inner] = np.arange(len(inner))
        self.table = np.full((len(inner) + 1, _COMMON + 2), -1, np.int32)
        column = self._column(self.keys & 0x1FFFFF)
        held = column <= _COMMON
        self.table[self.row[self.keys[held] >> 21], column[held]] = self.nodes[held]

    @staticmethod
    def _column(chars: np.ndarray) -> np.ndarray:
        return np.where(chars == ord(_SPACE), _COMMON, np.where(chars < _COMMON, chars, _COMMON + 1))

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The nodes one character further, -1 where there is none."""
        column = self._column(chars)
        out = self.table[self.row[nodes], column].astype(np.int64)
        rare = np.flatnonzero(column > _COMMON)
        wanted = nodes[rare] << 21 | chars[rare]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        out[rare] = np.where(self.keys[at] == wanted, self.nodes[at], -1)
        return out


class Lattice:
    """The lattices of distinct words. Node 0 is the end of a word; the others are places in the
    words; a node's edges lie side by side."""

    _BY_EDGE = ("target", "piece", "log_share", "log_rest", "cumulated")

    def __init__(self, trie: Trie, vocabulary: Vocabulary, words: list[str] | None = None):
        self.trie, self.vocabulary = trie, vocabulary
        self.known: dict[str, int] = {}
        self.first = np.zeros(0, np.int64)  # node of each word's start
        self.start = np.zeros(2, np.int64)  # first edge of each node, and the number of edges
        self.target = self.piece = np.zeros(0, np.int32)
        self.log_share = self.log_rest = self.cumulated = np.zeros(0)
        self.kept = 0, 1, 0  # words, nodes, edges
        self._add(words or [])

    def places(self, words: list[str]) -> np.ndarray:
        """Start nodes of words, unknown ones being added."""
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            fresh = [words[i] for i in unknown.tolist()]
            self._add(list(dict.fromkeys(fresh)))
            found[unknown] = np.fromiter(map(self.known.__getitem__, fresh), np.int64, len(fresh))
        return self.first[found]

    def forget(self) -> None:
        """Back to the last state within the bound, if the words since then exceed it."""
        if self.nbytes <= _KEPT_BYTES:
            self.kept = len(self.first), len(self.start) - 1, len(self.target)
            return
        words, nodes, edges = self.kept
        for word in list(self.known)[words:]:
            del self.known[word]
        self.first, self.start = self.first[:words].copy(), self.start[: nodes + 1].copy()
        for name in self._BY_EDGE:
            setattr(self, name, getattr(self, name)[:edges].copy())

    @property
    def nbytes(self) -> int:
        return self.start.nbytes + _WORD_BYTES * len(self.first) + sum(getattr(self, name).nbytes for name in self._BY_EDGE)

    def _add(self, words: list[str]) -> None:
        """More words; each name goes without the space that begins every word."""
        if not words:
            return
        trie, vocabulary = self.trie, self.vocabulary
        sizes = np.array([len(w) for w in words], np.int64) + 1
        chars = np.frombuffer((_SPACE + _SPACE.join(words)).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        n = len(chars)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(n)
        order = np.argsort(left.astype(np.uint16) if sizes.max() < 1 << 16 else left, kind="stable")
        number = np.zeros(n + 1, np.int64)  # in the order of the characters left
        number[order] = np.arange(1, n + 1)

        found = []  # nodes, targets, weights and pieces by the length of the piece
        places, node = np.arange(n), np.zeros(n, np.int64)

        def edges(places: np.ndarray, length: int, weights: np.ndarray, pieces: np.ndarray) -> None:
            found.append((number[places], np.where(left[places] == length, 0, number[places + length]), weights, pieces))

        for length in range(1, vocabulary.longest + 1):
            node = trie.step(node, chars[places + length - 1])
            held = node >= 0
            hit = held & (trie.piece[node] >= 0)
            edges(places[hit], length, trie.weight[node[hit]], trie.piece[node[hit]])
            if length == 1:  # a character without a piece is spelled in bytes
                bare = places[~hit]
                wide = 1 + (chars[bare] > 0x7F) + (chars[bare] > 0x7FF) + (chars[bare] > 0xFFFF)
                edges(bare, 1, wide * vocabulary.byte_weight, len(vocabulary.spelling) + chars[bare])
            going = held & (left[places] > length)
            places, node = places[going], node[going]
            if not len(places):
                break
        counts = np.zeros(n + 2, np.int64)
        for nodes, *_ in found:
            counts[nodes] += 1
        start = np.cumsum(counts) - counts
        count = int(start[-1])
        target, piece, value = np.empty(count, np.int32), np.empty(count, np.int32), np.empty(count)
        # Longest first: they are mostly the likeliest, and a step stops at the first that fits.
        free = start.copy()
        for nodes, targets, weights, pieces in reversed(found):
            slot = free[nodes]
            free[nodes] += 1
            target[slot], value[slot], piece[slot] = targets, weights, pieces
        total = np.zeros(n + 1)
        # Nodes with the same number of characters left are neighbours and need only shorter rests.
        levels = np.concatenate([[1], 1 + np.cumsum(np.bincount(left)[1:])])
        for low, high in zip(levels, levels[1:], strict=False):
            a, b = start[low], start[high]
            if a == b:
                continue
            value[a:b] += total[target[a:b]]
            begin = start[low:high] - a
            top = np.maximum.reduceat(value[a:b], begin)
            share = np.exp(value[a:b] - np.repeat(top, counts[low:high]))
            total[low:high] = top + np.log(np.add.reduceat(share, begin))
        log_share = value - np.repeat(total, counts[: n + 1])
        # Summed within each node, so that a word's numbers do not depend on its neighbours.
        cumulated = np.exp(log_share)
        at = np.arange(1, n + 1)
        for i in range(1, int(counts.max())):
            at = at[counts[at] > i]
            cumulated[start[at] + i] += cumulated[start[at] + i - 1]
        cumulated[start[2 : n + 2] - 1] = 1.0  # the last edge of each node

        nodes, edge_count = len(self.start) - 2, len(self.target)
        begins = number[ends - sizes] + nodes
        self.known.update(zip(words, range(len(self.first), len(self.first) + len(words)), strict=True))
        self.first = np.concatenate([self.first, begins])
        self.start = np.concatenate([self.start[:-1], start[1:] + edge_count])
        added = np.where(target > 0, target + np.int32(nodes), np.int32(0)), piece, log_share, _log_rest(log_share), cumulated
        for name, values in zip(self._BY_EDGE, added, strict=True):
            setattr(self, name, np.concatenate([getattr(self, name), values]))

    def walk(self, nodes: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edges of each word one after the other, number of edges of each word)."""
        at, words, node, steps = 0, np.flatnonzero(nodes > 0), nodes[nodes > 0], []
        while len(words):
            with np.errstate(over="ignore"):
                u = _uniform(noise[words] + np.uint64(at + 1) * _STEP)
            edge = self.start[node]
            behind = np.flatnonzero(self.cumulated[edge] < u)
            while len(behind):
                edge[behind] += 1
                behind = behind[self.cumulated[edge[behind]] < u[behind]]
            steps.append((words, edge))
            node = self.target[edge]
            going = node > 0
            words, node = words[going], node[going]
            at += 1
        count = np.zeros(len(nodes), np.int64)
        for w, _ in steps:
            count[w] += 1
        first = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for k, (w, e) in enumerate(steps):
            edges[first[w] + k] = e
        return edges, count


def words_of(text: str) -> list[str]:
    """The words of a text, without the space that begins each."""
    text = text.replace(_SPACE, _OWN)
    if not text or text[0] == " " or text[-1] == " " or "  " in text:
        return [w[1:] for w in _WORDS.findall(_SPACE + text.replace(" ", _SPACE))] if text else []
    return text.split(" ")


def _log_rest(log_share: np.ndarray) -> np.ndarray:
    """log(1 - share)."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(np.minimum(log_share, 0.0)))


class _Path:
    """A found path and the agenda of the sets beside it; its first ``branch`` steps belong to an
    earlier path, and the agenda begins behind them; ``taken`` are the edges that paths take where
    they part."""

    __slots__ = ("agenda", "branch", "count", "edges", "ends", "log_prob", "taken", "top", "value")

    def __init__(self, value: float, edges: np.ndarray, count: np.ndarray, branch: int, taken: list[int]):
        self.value, self.edges, self.count, self.branch, self.taken = value, edges, count, branch, taken
        self.ends = np.cumsum(count)

    def rank(self) -> None:
        best = int(self.agenda.argmax()) if len(self.agenda) else -1
        self.top = (float(self.agenda[best]), self.branch + best) if best >= 0 else (-np.inf, -1)


class _Document:
    """Found paths of one text."""

    __slots__ = ("key", "nodes", "paths")

    def __init__(self, key: np.uint64, nodes: np.ndarray):
        self.key, self.nodes = key, nodes
        self.paths: list[_Path] = []

    def at(self, walker: Lattice, path: _Path, step: int) -> tuple[int, int]:
        """(word, node) that a step of a path leaves."""
        word = int(path.ends.searchsorted(step, side="right"))
        if step == path.ends[word] - path.count[word]:
            return word, int(self.nodes[word])
        return word, int(walker.target[path.edges[step - 1]])

    def best(self) -> tuple[float, int]:
        """(value, path) of the best set on the agenda."""
        found = (-np.inf, -1)
        for i, path in enumerate(self.paths):
            if path.top[0] > found[0]:
                found = (path.top[0], i)
        return found


def _fill_agendas(walker: Lattice, documents: list[_Document], sample: int) -> None:
    """Agendas of the newest path of each document: per step, the best value of the paths that leave there."""
    newest = [d.paths[-1] for d in documents]
    sizes = np.array([len(p.edges) for p in newest], np.int64)
    edges = np.concatenate([p.edges for p in newest])
    cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    shares = walker.log_share[edges]
    before = np.empty_like(shares)
    for low, high in zip(cuts, cuts[1:], strict=False):
        np.cumsum(shares[low:high], out=before[low:high])
    before -= shares
    # Only the steps from each path's branch on; those before it are an earlier path's.
    branch = np.array([p.branch for p in newest], np.int64)
    steps = sizes - branch
    starts = np.concatenate([[0], np.cumsum(steps)])
    step = np.arange(starts[-1]) + np.repeat(branch - starts[:-1], steps)
    if branch.any():
        at = step + np.repeat(np.cumsum(sizes) - sizes, steps)
        edges, before = edges[at], before[at]
    starts = starts.tolist()
    mass = before + walker.log_rest[edges]
    for d, path, low in zip(documents, newest, starts, strict=False):
        if path.taken:
            _, node = d.at(walker, path, path.branch)
            rest = 1.0 - np.exp(walker.log_share[path.taken]).sum()
            open_ = rest > 1e-15 and len(path.taken) < walker.start[node + 1] - walker.start[node]
            mass[low] = before[low] + np.log(rest) if open_ else -np.inf
    keys = np.array([d.key for d in documents], np.uint64)
    step += 1
    with np.errstate(over="ignore", divide="ignore"):
        u = _uniform(np.repeat(_hash(keys + np.uint64(sample + 1) * _SAMPLE), steps) + step.astype(np.uint64) * _MIX[1])
        agenda = mass - np.log(np.exp(mass - np.repeat([p.value for p in newest], steps)) - np.log(u))
    agenda[~np.isfinite(mass)] = -np.inf
    for path, a, b, low, high in zip(newest, cuts, cuts[1:], starts, starts[1:], strict=False):
        path.log_prob = float(shares[a:b].sum())
        path.agenda = agenda[low:high]
        path.rank()


def _open_best(walker: Lattice, d: _Document, path: _Path, u: float) -> tuple:
    """(path, value, word, nodes to walk from, edges up to there within the word, step, edges taken at it)."""
    value, step = path.top
    path.agenda[step - path.branch] = -np.inf
    path.rank()
    word, node = d.at(walker, path, step)
    taken = path.taken if step == path.branch and path.taken else [int(path.edges[step])]
    first = int(walker.start[node])
    beside = np.ones(int(walker.start[node + 1]) - first, bool)
    beside[np.array(taken) - first] = False
    choices = first + np.flatnonzero(beside)
    share = np.exp(walker.log_share[choices])
    chosen = int(choices[min(int(np.cumsum(share).searchsorted(u * share.sum())), len(choices) - 1)])
    nodes = d.nodes[word:].copy()
    nodes[0] = walker.target[chosen]
    head = np.append(path.edges[path.ends[word] - path.count[word] : step], chosen)
    return path, value, word, nodes, head, step, [*taken, chosen]


def sample_texts(
    texts: list[str], keys: np.ndarray, k: int, trie: Trie, vocabulary: Vocabulary, walker: Lattice | None = None
) -> list[list[dict]]:
    """Up to k paths of each text: ids, log_prob, perturbed value and inclusion score, best first."""
    walker = walker or Lattice(trie, vocabulary)
    split = [words_of(t) for t in texts]
    every = walker.places([w for words in split for w in words])
    bounds = np.cumsum([0] + [len(w) for w in split])
    documents = [_Document(key, every[a:b]) for key, a, b in zip(keys, bounds, bounds[1:], strict=False)]
    with np.errstate(over="ignore"):
        roots = -np.log(-np.log(_uniform(keys)))
    for sample in range(k):
        if sample == 0:
            going = documents
            plans = [(None, float(root), 0, d.nodes, np.zeros(0, np.int64), 0, []) for d, root in zip(documents, roots, strict=True)]
        else:
            opened = [(d, *d.best()) for d in documents if len(d.paths) == sample]
            opened = [(d, d.paths[i]) for d, value, i in opened if value > -np.inf]
            going = [d for d, _ in opened]
            steps = np.array([path.top[1] for _, path in opened], np.uint64)
            with np.errstate(over="ignore"):
                u = _uniform(np.array([d.key for d in going], np.uint64) + np.uint64(sample + 1) * _MIX[0] + steps)
            plans = [_open_best(walker, d, path, float(x)) for (d, path), x in zip(opened, u, strict=True)]
        if not plans:
            break
        sizes = np.array([len(p[3]) for p in plans], np.int64)
        begins = np.cumsum(sizes) - sizes
        words = np.arange(int(sizes.sum())) - np.repeat(begins - np.array([p[2] for p in plans]), sizes)
        own = np.repeat(np.array([d.key for d in going], np.uint64), sizes)
        with np.errstate(over="ignore"):
            noise = _hash(own + np.uint64(sample + 1) * _SAMPLE + words.astype(np.uint64) * _WORD)
        walked, counts = walker.walk(np.concatenate([p[3] for p in plans]), noise)
        w = e = 0
        for d, (path, value, word, nodes, head, step, taken) in zip(going, plans, strict=True):
            count = counts[w : w + len(nodes)].copy()
            edges = walked[e : e + int(count.sum())]
            w, e = w + len(nodes), e + len(edges)
            if path is not None:
                count[0] += len(head)
                done = int(path.ends[word] - path.count[word])
                edges = np.concatenate([path.edges[:done], head, edges])
                count = np.concatenate([path.count[:word], count])
            d.paths.append(_Path(value, edges, count, step, taken))
        _fill_agendas(walker, going, sample)
    found = [p for d in documents for p in d.paths]
    edges = np.concatenate([p.edges for p in found]) if found else np.zeros(0, np.int64)
    spelled = iter(vocabulary.in_bytes(walker.piece[edges].astype(np.int64), np.array([len(p.edges) for p in found], np.int64)))
    out = []
    for d in documents:
        limit = d.best()[0]
        out.append([
            {
                "ids": next(spelled), "log_prob": p.log_prob, "perturbed": p.value,
                "inclusion": 1.0 if limit == -np.inf else float(-np.expm1(-np.exp(p.log_prob - limit))),
            }
            for p in d.paths
        ])
    return out


_WALKERS: dict[tuple[str, float], Lattice] = {}


def walker_of(model: str, power: float) -> Lattice:
    """One per worker process, with the words that it has met in earlier tasks."""
    if (model, power) not in _WALKERS:
        vocabulary = Vocabulary(model, power)
        _WALKERS[model, power] = Lattice(Trie(vocabulary), vocabulary)
    return _WALKERS[model, power]


def _keys(rows: pa.Array) -> np.ndarray:
    return np.array([(zlib.crc32(s) << 32) | zlib.crc32(s, 1) for s in (x.encode() for x in rows.to_pylist())], np.uint64)


_SCHEMA = (
    "doc_id bigint, sample int, n_pieces bigint, ids_crc32 bigint, log_prob double, perturbed double, inclusion double, "
    "round_trip boolean, ids binary"
)


def sampled(
    docs: DataFrame, model: str, k: int = SAMPLES, power: float = POWER, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row and sample: number, ids (little-endian 32 bits) and checksum, scores, and whether the ids decode to the text."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    held = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), key.alias("key"), text_or_empty(text).alias("text"))
    names = [part.split()[0] for part in _SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.binary()]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = walker_of(model, power)
        vocabulary = walker.vocabulary
        for batch in batches:
            rows, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            seeds = _keys(batch.column("key"))
            sizes = [len(texts[i].as_buffer() or b"") for i in range(len(texts))]
            for low, high in in_groups(sizes, _BATCH_CHARS):
                part = texts[low:high].to_pylist()
                columns: list[list] = [[] for _ in names]
                for i, paths in enumerate(sample_texts(part, seeds[low:high], k, walker.trie, vocabulary, walker)):
                    spelled = part[i].encode()
                    for number, p in enumerate(paths):
                        ids = p["ids"].tobytes()
                        values = (
                            rows[low + i], number, len(p["ids"]), zlib.crc32(ids), p["log_prob"], p["perturbed"], p["inclusion"],
                            vocabulary.decode(p["ids"]) == spelled, ids if with_ids else None,
                        )
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                walker.forget()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    out = held.mapInArrow(local, _SCHEMA)
    return out if with_ids else out.drop("ids")
