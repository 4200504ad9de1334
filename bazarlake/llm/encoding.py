"""Token ids of whole texts by the tokenizers library, with a cache of chunks in each worker.

A byte-level vocabulary with this pre-tokenizer never joins across a single space that is followed
by a character other than white space. Texts are cut there; each chunk (with its leading space) is
encoded by the library once and kept. The ids are those of the whole text, special strings
included, for these lie within a chunk. White space here is Python's, a superset of the library's,
so a cut is never made where the library would join.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

_DOUBTFUL = re.compile(r" (?=\s|\Z)")
_CUT = re.compile(r" (?=\S)")
#: Plain letters, then marks that can begin no contraction.
_WORD_AND_MARKS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]+)")
#: Bytes of kept chunks and their ids, Python's own overhead of an entry included.
_CACHED_BYTES = 96 << 20
_ENTRY_BYTES = 200
_LONGEST = 48
#: Unknown chunks that are encoded as one text.
_JOINED = 64


def tokenizer_of(path: str):
    """The library's tokenizer without truncation, padding or own threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def chunks_of(text: str) -> list[str]:
    """Pieces of a text; all but the first begin after the space that belongs to them."""
    return _CUT.split(text) if _DOUBTFUL.search(text) else text.split(" ")


class Encoder:
    """Encodes batches of texts to little-endian unsigned ids; memory is bounded."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer_of(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        #: Bytes of each token: a byte-level vocabulary has one letter per byte.
        self.length = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        self.known: dict[str, bytes] = {}
        self.kept = 0
        self.marks: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        code = "H" if self.dtype.itemsize == 2 else "I"
        return [array(code, e.ids).tobytes() for e in found]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, many encoded as one text and cut at the chunks' ends.

        A chunk ends where a token ends, or the texts are encoded one by one.
        """
        groups = [chunks[i : i + _JOINED] for i in range(0, len(chunks), _JOINED)]
        out: list[bytes] = []
        for group, ids in zip(groups, self._ids([" " + " ".join(g) for g in groups]), strict=True):
            ends = np.cumsum(self.length[np.frombuffer(ids, self.dtype)])
            stops = np.cumsum([1 + len(c.encode()) for c in group])
            at = np.searchsorted(ends, stops)
            if ends[-1] == stops[-1] and (ends[at] == stops).all():
                cuts = [0, *((at + 1) * self.dtype.itemsize).tolist()]
                out += [ids[low:high] for low, high in zip(cuts, cuts[1:])]
            else:
                out += self._ids([" " + c for c in group])
        return out

    def _from_parts(self, chunk: str) -> bytes | None:
        """Ids of a known word and the marks after it: letters and marks are never one pre-token."""
        parts = _WORD_AND_MARKS.fullmatch(chunk)
        word = self.known.get(parts[1]) if parts else None
        if word is None:
            return None
        marks = self.marks.get(parts[2])
        if marks is None:
            (marks,) = self._ids([parts[2]])
            if len(self.marks) < 1000:
                self.marks[parts[2]] = marks
        return word + marks

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known
        pieces = [chunks_of(t) for t in texts]
        heads = self._ids([p[0] for p in pieces])
        values = [list(map(known.get, p[1:])) for p in pieces]
        missing: dict[str, bytes] = {}
        for p, v in zip(pieces, values, strict=True):
            if None in v:
                missing.update((p[i + 1], b"") for i, x in enumerate(v) if x is None)
        if missing:
            missing = {c: self._from_parts(c) for c in missing}
            order = [c for c, ids in missing.items() if ids is None]
            missing.update(zip(order, self._chunks(order), strict=True))
            for p, v in zip(pieces, values, strict=True):
                if None in v:
                    v[:] = [missing[p[i + 1]] if x is None else x for i, x in enumerate(v)]
            if self.kept > _CACHED_BYTES:
                known.clear()
                self.kept = 0
            for c, ids in missing.items():
                if len(c) <= _LONGEST:
                    known[c] = ids
                    self.kept += len(c) + len(ids) + _ENTRY_BYTES
        return [np.frombuffer(head + b"".join(v), self.dtype) for head, v in zip(heads, values, strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One per worker process, with the chunks that it has met in earlier tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def in_groups(sizes, most: int):
    """Ranges of consecutive items of at most ``most`` together, one item at least."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
