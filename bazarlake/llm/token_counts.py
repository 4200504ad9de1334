"""Token counts by a two-tier lookup on the map side.

First tier: a compact table of the corpus' most frequent chunks (a chunk is the run of pre-tokens
from one cutting space to the next, see ``encoding``) with their token counts, broadcast to all
tasks. Second tier: each worker keeps what it has encoded itself. Only the rest goes to the
tokenizers library. No pre-token is shuffled: every task counts its own chunks in bounded memory
and gives one row, a table of its ``TASK_CHUNKS`` most frequent; these rows are merged in a tree.
The tables only decide what is looked up: counts are exact whatever they hold.

Bounds: the broadcast table has ``SHARED_CHUNKS`` chunks of at most 48 characters; the driver sees
at most ``FAN_IN`` tables of ``SHARED_CHUNKS`` chunks, from every text of the corpus.

Defined cases: a null text is an empty one, with 0 bytes and 0 tokens; long texts are counted
whole; repeated rows and null ids give a row each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import text_or_empty
from bazarlake.llm.encoding import chunks_of, in_groups, tokenizer_of

TASK_CHUNKS = 4096
SHARED_CHUNKS = 16384
FAN_IN = 16
_COUNTED = 200_000
_KEPT = 200_000
_LONGEST = 48
_BATCH_CHARS = 1 << 20
_TABLE = "chunks array<string>, counts array<bigint>"


def _top(counts: Counter, most: int) -> pa.RecordBatch:
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]
    return pa.RecordBatch.from_arrays(
        [pa.array([[c for c, _ in best]], pa.list_(pa.string())), pa.array([[n for _, n in best]], pa.list_(pa.int64()))],
        names=["chunks", "counts"],
    )


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table per task. Beyond the bound, chunks that are rare so far are forgotten."""
    counts: Counter = Counter()
    floor = 1
    for batch in batches:
        for text in batch.column("text"):
            counts.update(c for c in chunks_of(text.as_py())[1:] if len(c) <= _LONGEST)
            while len(counts) > _COUNTED:
                counts = Counter({c: n for c, n in counts.items() if n > floor})
                floor += len(counts) > _COUNTED // 2
    if counts:
        yield _top(counts, TASK_CHUNKS)


def _merge_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for chunks, numbers in zip(batch.column("chunks"), batch.column("counts"), strict=True):
            for chunk, n in zip(chunks.as_py(), numbers.as_py(), strict=True):
                counts[chunk] += n
        if len(counts) > 4 * SHARED_CHUNKS:
            counts = Counter(dict(counts.most_common(2 * SHARED_CHUNKS)))
    if counts:
        yield _top(counts, SHARED_CHUNKS)


def frequent_chunks(docs: DataFrame, text: str = "text") -> list[str]:
    """The most frequent chunks of all texts, merged in a tree of tasks."""
    texts = docs.select(text_or_empty(text).alias("text"))
    tables, width = texts.mapInArrow(_count_task, _TABLE), texts.rdd.getNumPartitions()
    while width > FAN_IN:
        width = -(-width // FAN_IN)
        tables = tables.repartition(width).mapInArrow(_merge_tables, _TABLE)
    counts: Counter = Counter()
    for row in tables.collect():  # at most FAN_IN tables of bounded size
        counts.update(dict(zip(row.chunks, row.counts, strict=True)))
    return [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:SHARED_CHUNKS]]


def counted(docs: DataFrame, tokenizer: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    frequent = frequent_chunks(docs, text)
    lengths = [len(e.ids) for e in tokenizer_of(tokenizer).encode_batch_fast([" " + c for c in frequent], add_special_tokens=False)]
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent, lengths, strict=True)))

    @F.arrow_udf("bigint")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = tokenizer_of(tokenizer)
        own: dict[str, int] = {}
        common = shared.value

        def encode(pieces: list[str]) -> list[int]:
            return [len(e.ids) for e in library.encode_batch_fast(pieces, add_special_tokens=False)]

        def count(texts: list[str]) -> list[int]:
            pieces = [chunks_of(t) for t in texts]
            totals = encode([p[0] for p in pieces])
            misses: list[list[str]] = []
            wanted: dict[str, int] = {}
            for i, p in enumerate(pieces):
                del p[0]
                first = list(map(common.get, p))
                rest = [c for c, n in zip(p, first, strict=True) if n is None] if None in first else []
                totals[i] += sum(n for n in first if n is not None) if rest else sum(first)
                misses.append(rest)
                wanted.update((c, 0) for c in rest if c not in own)
            if wanted:
                wanted = dict(zip(wanted, encode([" " + c for c in wanted]), strict=True))
            for i, rest in enumerate(misses):
                totals[i] += sum(wanted[c] if c in wanted else own[c] for c in rest)
            if len(own) > _KEPT:
                own.clear()
            own.update((c, n) for c, n in wanted.items() if len(c) <= _LONGEST)
            return totals

        for batch in batches:
            sizes = [len(batch[i].as_buffer() or b"") for i in range(len(batch))]
            out: list[int] = []
            for low, high in in_groups(sizes, _BATCH_CHARS):
                out += count(batch[low:high].to_pylist())
            yield pa.array(out, pa.int64())

    held = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return held.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), n_tokens("text").alias("n_tokens")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
