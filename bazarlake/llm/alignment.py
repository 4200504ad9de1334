"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide pair counts.

Byte offsets at which tokens of both sides end cut a text into groups; tokens of both sides whose
byte ranges overlap are linked, and a pair of ids counts the documents that hold it linked.

Identity fast path: for every id of A an array holds the id of B with the same bytes, if there is
one. Such pairs, above all the groups of one token on either side, are counted in vectors as long
as A's vocabulary, one per task, and summed; they never become rows of a shuffle. Only the other
pairs, of irregular groups, are shuffled, counted within the task before.

Chunks: no token of either side crosses a single space between two other characters (A's pre-
tokenizer splits there, and B has no piece with a space after another character), so a text is the
sequence of its chunks and each worker aligns a distinct chunk once and keeps it.

The second look-up of the counts is a broadcast for the identity vector (as long as A's vocabulary)
and for the pairs that make up at least one in ``SHARED_PAIRS`` of all rows, of which there can be
no more than ``SHARED_PAIRS``; the rarer ones are joined, where no key is frequent by construction.

Defined cases: texts that are null, empty or not restored by both sides have no tokens and zeros;
special strings are plain text; very long texts are aligned whole, chunk by chunk; repeated rows
and null ids give a row each and count each; ties for the highest count all count as best; further
columns of the documents are not read, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import text_or_empty
from bazarlake.llm.encoding import in_groups
from bazarlake.operators.workdir import fresh_folder, materialize

SHARED_PAIRS = 200_000
#: Tables that the driver sums, however many tasks there are.
FAN_IN = 16
_CACHED_CHUNKS = 300_000
_LONGEST = 64
_LONG_CHARS = 1 << 22
_BATCH_CHARS = 1 << 18
_HELD_PAIRS = 1 << 20
_DOUBTFUL = re.compile(r"\A | (?=\s|\Z)")
_CUT = re.compile(r"(?<! ) (?=\S)")

_DIGEST = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


# ---------------------------------------------------------------- vocabularies


def _byte_letters() -> dict[str, int]:
    """Byte-level letters: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        self.a_bytes = [bytes(letters[c] for c in (self.a.id_to_token(i) or "")) for i in range(self.a.get_vocab_size())]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        self.a_len = np.array([len(x) for x in self.a_bytes])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        ids: dict[bytes, int] = {}
        for i, x in enumerate(self.b_bytes):
            if not self.b.is_byte(i):
                ids.setdefault(x, i)
        #: A's id to B's id with the same bytes, or -1.
        self.same = np.array([ids.get(x, -1) for x in self.a_bytes])

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]

    def encode_b(self, chunks: list[str]) -> list[list[int]]:
        return self.b.encode(chunks, num_threads=1)


def chunks_of(text: str) -> list[str]:
    """Chunks of " " + text without the space that each begins with."""
    if not _DOUBTFUL.search(text):
        return text.split(" ")
    parts = _CUT.split(" " + text)
    return parts[1:] if not parts[0] else [parts[0][1:], *parts[1:]]


# ---------------------------------------------------------------- chunks, aligned once each


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``count`` numbers each, end to end."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


class Aligner:
    """Aligns texts; the chunks that it has seen are kept in flat arrays of bounded size."""

    def __init__(self, words: Vocabularies):
        self.words = words
        self.known: dict[str, int] = {}
        most = max(words.a_size, words.b_size)
        self.marked = [[b"%d%s" % (i, mark) for i in range(most)] for mark in (b",", b"|", b";")]
        self.forget()

    def forget(self) -> None:
        self.known.clear()
        self.long = 0  # characters of long chunks
        self.groups: list[bytes | None] = []  # None: not restored
        self.figures = np.zeros((0, 4), np.int64)
        self.pair_at, self.pair_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Adds chunks, all of them at once."""
        words = self.words
        a_ids, b_ids, strings = words.encode_a(chunks), words.encode_b(chunks), [(" " + c).encode() for c in chunks]
        good = [
            b"".join([words.a_bytes[i] for i in a]) == s == b"".join([words.b_bytes[i] for i in b])
            for a, b, s in zip(a_ids, b_ids, strings, strict=True)
        ]
        held = [k for k, ok in enumerate(good) if ok]
        a_n, b_n = np.array([len(a_ids[k]) for k in held], int), np.array([len(b_ids[k]) for k in held], int)
        a = np.array([i for k in held for i in a_ids[k]], int)
        b = np.array([i for k in held for i in b_ids[k]], int)
        # Chunks end at the same offset on both sides, so they can be laid end to end.
        a_end, b_end = np.cumsum(words.a_len[a]), np.cumsum(words.b_len[b])
        a_start, b_start = a_end - words.a_len[a], b_end - words.b_len[b]
        a_cut, b_cut = np.isin(a_end, b_end, assume_unique=True), np.isin(b_end, a_end, assume_unique=True)
        first = np.searchsorted(b_end, a_start, "right")
        count = np.searchsorted(b_start, a_end, "left") - first
        a_chunk, b_chunk = np.repeat(np.arange(len(held)), a_n), np.repeat(np.arange(len(held)), b_n)
        size = len(held)
        figures = np.zeros((len(chunks), 4), np.int64)
        for column, values in enumerate(
            (a_n, b_n, np.bincount(a_chunk, a_cut, size), np.bincount(a_chunk, count, size))
        ):
            figures[held, column] = values
        code = np.repeat(a, count) * words.b_size + b[_ranges(first, count)]
        codes = words.a_size * words.b_size
        both, times = np.unique(np.repeat(a_chunk, count) * codes + code, return_counts=True)
        pair_n = np.zeros(len(chunks), np.int64)
        pair_n[held] = np.bincount(both // codes, minlength=size)

        comma, bar, end = self.marked
        written = [bar[i] if cut else comma[i] for i, cut in zip(a.tolist(), a_cut.tolist(), strict=True)]
        written += [end[i] if cut else comma[i] for i, cut in zip(b.tolist(), b_cut.tolist(), strict=True)]
        group = np.concatenate([np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut])
        ordered = [written[i] for i in np.argsort(group, kind="stable").tolist()]  # A's tokens stand first
        texts: list[bytes | None] = [None] * len(chunks)
        stop = np.cumsum(a_n + b_n).tolist()
        begin = 0
        for k, upto in zip(held, stop, strict=True):
            texts[k] = b"".join(ordered[begin:upto])
            begin = upto

        at = len(self.groups)
        self.known.update(zip(chunks, range(at, at + len(chunks)), strict=True))
        self.groups += texts
        self.figures = np.concatenate([self.figures, figures])
        self.pair_at = np.concatenate([self.pair_at, len(self.pairs) + np.cumsum(pair_n) - pair_n])
        self.pair_n = np.concatenate([self.pair_n, pair_n])
        self.pairs = np.concatenate([self.pairs, both % codes])
        self.times = np.concatenate([self.times, times])

    def align(self, texts: list[str]):
        """Per text: figures (a, b, groups, links), digest, and its pairs' codes and times (flat, with bounds)."""
        known = self.known
        pieces = [chunks_of(t) if t else [] for t in texts]
        missing = {c for p in pieces for c in p if c not in known}
        if missing:
            if len(self.groups) + len(missing) > _CACHED_CHUNKS:
                self.forget()
                missing = {c for p in pieces for c in p}
            order = sorted(missing)
            for low, high in in_groups([len(c) for c in order], _BATCH_CHARS):
                self._learn(order[low:high])
        rows = [[known[c] for c in p] for p in pieces]
        whole, digests = [], []
        for row in rows:
            parts = [self.groups[i] for i in row]
            good = bool(parts) and None not in parts
            whole.append(good)
            digests.append(hashlib.sha256(b"".join(parts)[:-1]).hexdigest() if good else "")
        rows = [row if good else [] for row, good in zip(rows, whole, strict=True)]
        sizes = np.array([len(r) for r in rows], int)
        chunk = np.array([i for r in rows for i in r], np.int64)
        text = np.repeat(np.arange(len(texts)), sizes)
        figures = np.stack([np.bincount(text, self.figures[chunk, c], len(texts)) for c in range(4)], axis=1).astype(np.int64)
        # Distinct chunks of each text, then the distinct pairs of these.
        own, repeats = np.unique(text * len(self.groups) + chunk, return_counts=True)
        text, chunk = own // max(1, len(self.groups)), own % max(1, len(self.groups))
        at = _ranges(self.pair_at[chunk], self.pair_n[chunk])
        n = self.pair_n[chunk]
        codes = self.words.a_size * self.words.b_size
        key = np.repeat(text, n) * codes + self.pairs[at]
        key, inverse = np.unique(key, return_inverse=True)
        times = np.bincount(inverse, np.repeat(repeats, n) * self.times[at], len(key)).astype(np.int64)
        bounds = np.searchsorted(key, np.arange(len(texts) + 1) * codes)
        self.long += sum(len(c) for c in missing if len(c) > _LONGEST)
        if self.long > _LONG_CHARS:
            self.forget()
        return figures, digests, key % codes, times, bounds


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process, with all that it has learnt in earlier tasks."""
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(Vocabularies(a_path, b_path))
    return _ALIGNERS[key]


def aligned(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the digest columns, and ``pairs`` (codes) with their ``times`` in the text, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        for batch in batches:
            texts = batch.column("text")
            sizes = [len(texts[i].as_buffer() or b"") for i in range(len(texts))]
            for low, high in in_groups(sizes, _BATCH_CHARS):
                figures, digests, pairs, times, bounds = aligner.align(texts[low:high].to_pylist())
                offsets = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row")[low:high],
                        batch.column("doc_id")[low:high],
                        *[pa.array(figures[:, c]) for c in range(4)],
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(pairs)),
                        pa.ListArray.from_arrays(offsets, pa.array(times)),
                    ],
                    names=["row", *_DIGEST, "pairs", "times"],
                )

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    held = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return held.mapInArrow(run, schema)


# ---------------------------------------------------------------- counts over the corpus


def _flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _is_same(pairs: np.ndarray, same: np.ndarray, b_size: int) -> np.ndarray:
    return same[pairs // b_size] == pairs % b_size


def same_counts(found: DataFrame, same: np.ndarray, b_size: int) -> np.ndarray:
    """Documents that hold each A id linked with its same-bytes id; a vector per task, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(same), np.int64)
        for batch in batches:
            pairs = _flat(batch.column("pairs"))
            total += np.bincount(pairs[_is_same(pairs, same, b_size)] // b_size, minlength=len(same))
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(same), np.int64)
        for batch in batches:
            total += _flat(batch.column("counts")).reshape(-1, len(same)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["counts"])

    schema = "counts array<bigint>"
    vectors = found.select("pairs").mapInArrow(count, schema).repartition(FAN_IN).mapInArrow(add, schema)
    rows = vectors.collect()  # FAN_IN vectors of the vocabulary's length
    return np.sum([np.array(r.counts) for r in rows], axis=0) if rows else np.zeros(len(same), np.int64)


def other_counts(found: DataFrame, same: np.ndarray, b_size: int) -> DataFrame:
    """(pair, n): documents per pair of irregular groups, counted within tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, inverse = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pairs, np.bincount(inverse, np.concatenate([n for _, n in held]), len(pairs)).astype(np.int64)

        for batch in batches:
            pairs = _flat(batch.column("pairs"))
            pairs, n = np.unique(pairs[~_is_same(pairs, same, b_size)], return_counts=True)
            held.append((pairs, n))
            size += len(pairs)
            if size > _HELD_PAIRS:
                held = [merged()]
                size = len(held[0][0])
                if size > _HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["pair", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["pair", "n"])

    parts = found.select("pairs").mapInArrow(count, "pair bigint, n bigint")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- report


def report(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", shared: int = SHARED_PAIRS) -> DataFrame:
    """Per row: the digest, ``n_best`` and ``count_sum``."""
    spark = docs.sparkSession
    words = Vocabularies(a_path, b_path)
    same, b_size = words.same, words.b_size
    path = fresh_folder(spark, "aligned")
    aligned(docs, a_path, b_path, doc_id, text).write.option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path)

    identity = same_counts(found, same, b_size)
    others = materialize(other_counts(found, same, b_size))
    best = identity.copy()
    a_of = F.expr(f"pair div {b_size}")
    for row in others.groupBy(a_of.alias("a")).agg(F.max("n").alias("n")).toLocalIterator():  # a row per A id at most
        best[row.a] = max(best[row.a], row.n)
    rows = others.agg(F.sum("n")).first()[0] or 0
    floor = max(1, -(-rows // shared))  # no more than ``shared`` pairs can have as many
    frequent = others.filter(F.col("n") >= floor).orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast(
        (identity, best, frequent.column("pair").to_numpy(), frequent.column("n").to_numpy())
    )

    def looked_up(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair and whether it is known: all but the rare irregular ones."""
        identity, _, keys, counts = table.value
        is_same = _is_same(pairs, same, b_size)
        at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
        is_frequent = (keys[at] == pairs) & ~is_same if len(keys) else np.zeros(len(pairs), bool)
        n = np.where(is_same, identity[pairs // b_size], 0)
        n[is_frequent] = counts[at[is_frequent]]
        return n, is_same | is_frequent

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = _flat(batch.column("pairs")), _flat(batch.column("times"))
            sizes = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False).astype(int)
            n, held = looked_up(pairs)
            owner = np.repeat(np.arange(len(batch)), sizes)
            top = held & (n == table.value[1][pairs // b_size])
            # Exact: sums stay below 2 ** 53.
            n_best = np.bincount(owner, times * top, len(batch)).astype(np.int64)
            count_sum = np.bincount(owner, times * n, len(batch)).astype(np.int64)
            columns = [batch.column(c) for c in ("row", *_DIGEST)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best), pa.array(count_sum)], names=["row", *_DIGEST, "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = _flat(batch.column("pairs")), _flat(batch.column("times"))
            sizes = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False).astype(int)
            rest = ~looked_up(pairs)[1]
            row = np.repeat(batch.column("row").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(x[rest]) for x in (row, pairs, times)], names=["row", "pair", "times"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.select("row", *_DIGEST).schema)
    known_rows = found.select("row", *_DIGEST, "pairs", "times").mapInArrow(known, f"{kinds}, n_best bigint, count_sum bigint")
    if floor > 1:
        highest = spark.createDataFrame([(a, int(n)) for a, n in enumerate(best.tolist()) if n], "a bigint, best bigint")
        counted = others.filter(F.col("n") < floor).select("pair", "n", a_of.alias("a"))
        counted = counted.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("best")).alias("top"))
        rows = found.select("row", "pairs", "times").mapInArrow(rare, "row bigint, pair bigint, times bigint")
        more = rows.join(counted, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
        known_rows = known_rows.join(more, "row", "left").withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
            }
        )
    return known_rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
