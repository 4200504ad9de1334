"""Best-fit-decreasing packing into token-id matrices.

Documents longer than a row are split into whole rows and a rest, losslessly. Pieces are taken from
the longest down, and each goes to the open row with the least room that still holds it; a segment
tree over the room sizes finds it in a logarithm of the row length. Every row of the result is one
row of the id matrix, with the cumulative lengths of its segments and position ids that restart at
each segment; :func:`unpacked` gives the documents' ids back.

Packing is local to groups of up to ``GROUP_TOKENS`` tokens of one input partition, so nothing is
shuffled and no source or copied text can fill a task. Row ids carry the partition's number.

Defined cases: a null text is an empty one and gives its end token only; repeated rows and null ids
are packed as they come; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import text_or_empty
from bazarlake.llm.encoding import encoder_of, in_groups

CAPACITY = 2048
GROUP_TOKENS = 1 << 20
END_ID = 50256
_BATCH_CHARS = 1 << 20
_PARTITION_BITS = 36


class RoomTree:
    """Which room sizes occur among the open rows; finds the least that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row with at least ``length`` room, which it removes."""
        node = length + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Rows of (document, start, length). Every token is in exactly one piece."""
    pieces = [
        (min(capacity, length - start), document, start)
        for document, length in enumerate(lengths)
        for start in range(0, length, capacity)
    ]
    rows: list[list[tuple[int, int, int]]] = []
    tree = RoomTree(capacity)
    for length, document, start in sorted(pieces, key=lambda p: (-p[0], p[1], p[2])):
        found = tree.take(length)
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append((document, start, length))
        if room > length:
            tree.add(room - length, row)
    return rows


_SCHEMA = (
    "sequence_id bigint, n_tokens int, doc_ids array<bigint>, doc_starts array<bigint>, doc_tokens array<bigint>, "
    "cu_seqlens array<int>, input_ids binary, position_ids binary"
)


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per matrix row: ids padded with ``end_id`` (little-endian, as wide as the vocabulary needs),
    the pieces in order, cumulative lengths from 0, and 16-bit position ids (32-bit beyond 65,536)."""
    held = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    places = np.dtype("<u2" if capacity <= 1 << 16 else "<u4")
    names = [part.split()[0] for part in _SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]

    def flush(ids: list, tokens: list[np.ndarray], first: int) -> Iterator[pa.RecordBatch]:
        rows = best_fit([len(t) for t in tokens], capacity)
        for low in range(0, len(rows), 256):
            columns: list[list] = [[] for _ in names]
            for number, row in enumerate(rows[low : low + 256], first + low):
                ends = np.cumsum([0] + [length for _, _, length in row])
                line = np.full(capacity, end_id, tokens[row[0][0]].dtype)
                position = np.zeros(capacity, places)
                for (document, start, length), at in zip(row, ends, strict=False):
                    line[at : at + length] = tokens[document][start : start + length]
                    position[at : at + length] = np.arange(length)
                values = (
                    number, int(ends[-1]), [ids[d] for d, _, _ in row], [s for _, s, _ in row], [len(tokens[d]) for d, _, _ in row], ends.tolist(), line.tobytes(), position.tobytes()
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        first = TaskContext.get().partitionId() << _PARTITION_BITS
        ids: list = []
        tokens: list[np.ndarray] = []
        total = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            nonlocal first, total
            for out in flush(ids, tokens, first):
                first += len(out)
                yield out
            ids.clear()
            tokens.clear()
            total = 0

        for batch in batches:
            texts, own = batch.column("text"), batch.column("doc_id").to_pylist()
            sizes = [len(texts[i].as_buffer() or b"") for i in range(len(texts))]
            for low, high in in_groups(sizes, _BATCH_CHARS):
                for i, found in enumerate(encoder.encode(texts[low:high].to_pylist()), low):
                    ids.append(own[i])
                    tokens.append(np.append(found, found.dtype.type(end_id)))
                    total += len(tokens[-1])
                    if total >= group_tokens:
                        yield from emptied()
        yield from emptied()

    return held.mapInArrow(local, _SCHEMA)


def unpacked(rows: DataFrame, id_bytes: int = 2) -> DataFrame:
    """(doc_id, start, ids) of every piece, from the matrix rows alone: the way back."""
    dtype = np.dtype(f"<u{id_bytes}")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                line = np.frombuffer(row["input_ids"], dtype).astype(np.int64)
                ends = row["cu_seqlens"]
                parts = [line[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["doc_starts"], pa.int64()), pa.array(parts, pa.list_(pa.int64()))],
                    names=["doc_id", "start", "ids"],
                )

    return rows.select("doc_ids", "doc_starts", "cu_seqlens", "input_ids").mapInArrow(
        pieces, "doc_id bigint, start bigint, ids array<bigint>"
    )
