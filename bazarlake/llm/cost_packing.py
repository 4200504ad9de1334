"""Cost-balanced packing of documents into sequences of a fixed token capacity.

A piece of ``n`` tokens costs ``LINEAR * n + QUADRATIC * n * n``: the layers' work grows with the
tokens, that of attention with the square of each piece. Pieces are taken by descending cost and
go to the sequence of the lowest cost among all that still have room for them. The number of sequences is what
the tokens need, so almost nothing is padded; a piece that fits nowhere whole is cut over the
emptiest sequences, and the last few tokens of a group form sequences of power-of-two lengths,
which batches of their own shape run without padding.

Packing is local to a group of up to ``GROUP_TOKENS`` tokens of one input partition: no text or id
is shuffled, no group grows with a source or a copy, and a lost task is simply repeated. Sequence
ids are unique: the partition's number is in the upper bits. They follow the input's partitions.

Defined cases: a null text is an empty one and gives its end token only; long texts are cut at the
capacity; repeated rows and null ids are packed as they come; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import text_or_empty
from bazarlake.llm.encoding import encoder_of, in_groups

CAPACITY = 1024
LINEAR = 1.0
QUADRATIC = 1.0 / 1024
GROUP_TOKENS = 1 << 20
END_ID = 0
_BATCH_CHARS = 1 << 20
_PARTITION_BITS = 36


@dataclass(frozen=True)
class Piece:
    document: int
    start: int
    length: int
    sequence: int
    offset: int


def _powers(n: int) -> list[int]:
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


class _Open:
    """Sequences by the room they have left: a heap by cost for each room, and the least cost of each."""

    def __init__(self, capacity: int):
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
        self.least = np.full(capacity + 1, np.inf)
        self.most = 0  # no sequence has more room than this

    def put(self, room: int, cost: float, b: int) -> None:
        if room:
            heapq.heappush(self.heaps[room], (cost, b))
            self.least[room] = self.heaps[room][0][0]
            self.most = max(self.most, room)

    def holds(self, length: int) -> bool:
        while self.most and not self.heaps[self.most]:
            self.most -= 1
        return self.most >= length

    def cheapest(self, length: int) -> tuple[float, int]:
        """Takes out the sequence of the lowest cost among all that have room for the length."""
        room = length + int(self.least[length : self.most + 1].argmin())
        found = heapq.heappop(self.heaps[room])
        self.least[room] = self.heaps[room][0][0] if self.heaps[room] else np.inf
        return found


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[Piece]:
    """Places every token of the documents once; sequences are numbered from 0, offsets are gapless."""
    out: list[Piece] = []
    sequence = 0
    tails: list[tuple[int, int, int]] = []  # (length, document, start)
    for document, length in enumerate(lengths):
        whole = length // capacity
        for k in range(whole):
            out.append(Piece(document, k * capacity, capacity, sequence, 0))
            sequence += 1
        if rest := length % capacity:
            tails.append((rest, document, whole * capacity))
    total = sum(t[0] for t in tails)
    bins = total // capacity
    rooms = [capacity] * bins + _powers(total % capacity)
    fill = [0] * len(rooms)
    # Sequences of full capacity come first. The short ones at the end take what fits in none of them.
    full, short = _Open(capacity), _Open(capacity)
    for b, room in enumerate(rooms):
        (full if b < bins else short).put(room, 0.0, b)
    left: list[tuple[int, int, int]] = []
    for length, document, start in sorted(tails, key=lambda t: (-t[0], t[1], t[2])):
        held = full if full.holds(length) else short
        if not held.holds(length):
            left.append((length, document, start))
            continue
        cost, b = held.cheapest(length)
        out.append(Piece(document, start, length, sequence + b, fill[b]))
        fill[b] += length
        held.put(rooms[b] - fill[b], cost + linear * length + quadratic * length * length, b)
    gaps = sorted(((rooms[b] - fill[b], b) for b in range(len(rooms)) if fill[b] < rooms[b]), key=lambda g: (-g[0], g[1]))
    k = 0
    for length, document, start in left:
        while length:
            room, b = gaps[k]
            part = min(room, length)
            out.append(Piece(document, start, part, sequence + b, fill[b]))
            fill[b] += part
            start, length = start + part, length - part
            if part == room:
                k += 1
            else:
                gaps[k] = (room - part, b)
    return out


_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, token_ids binary"
)


def packed(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    group_tokens: int = GROUP_TOKENS,
    with_ids: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per piece: document, place in it, sequence and offset, checksum and (if asked for) the ids."""
    held = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))

    def flush(names: list, tokens: list[np.ndarray], first: int) -> tuple[pa.RecordBatch, int]:
        pieces = pack([len(t) for t in tokens], capacity)
        columns: list[list] = [[] for _ in range(8)]
        for p in pieces:
            ids = tokens[p.document][p.start : p.start + p.length].astype("<u4").tobytes()
            row = (names[p.document], p.start, p.length, zlib.crc32(ids), len(tokens[p.document]), first + p.sequence, p.offset, ids if with_ids else None)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.binary())]
        labels = [part.split()[0] for part in _SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(arrays, names=labels), 1 + max((p.sequence for p in pieces), default=-1)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        first = TaskContext.get().partitionId() << _PARTITION_BITS
        names: list = []
        tokens: list[np.ndarray] = []
        held_tokens = 0
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id").to_pylist()
            sizes = [len(texts[i].as_buffer() or b"") for i in range(len(texts))]
            for low, high in in_groups(sizes, _BATCH_CHARS):
                for i, found in enumerate(encoder.encode(texts[low:high].to_pylist()), low):
                    names.append(ids[i])
                    tokens.append(np.append(found, encoder.dtype.type(END_ID)))
                    held_tokens += len(tokens[-1])
                    if held_tokens >= group_tokens:
                        out, used = flush(names, tokens, first)
                        yield out
                        first += used
                        names, tokens, held_tokens = [], [], 0
        if names:
            yield flush(names, tokens, first)[0]

    out = held.mapInArrow(local, _SCHEMA)
    return out if with_ids else out.drop("token_ids")
