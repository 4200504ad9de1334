"""Spelling variants: words one edit apart, found by a bit-sliced position index.

The index holds, for every position and letter, the set of vocabulary words with that letter at
that position, as bits. For a query word, word-parallel recurrences advance position by position
over the whole index at once and track two kinds of sets: the words that agree so far (no error),
and those with exactly one error so far: a replaced letter (same position), one letter more than
the query (position shifted by one ahead) or one less (shifted by one back). All queries of a block
advance together.

The vocabulary is split for this by exact keys. Of two words one edit apart, let the longer have
``long`` letters and let them part at ``lcp``. Then either their first ``long // 2`` letters agree
or the last ``long - long // 2`` do, depending on whether ``lcp`` reaches the half. So each word
goes under the keys (first half) and (last half), once for its own length and once for one letter
more. A key with more than ``CROWDED`` words is halved again within the part that is left open,
until that part is a single letter, where a key can hold one word per letter of the alphabet and
one shorter word; so blocks are bounded whatever the data. A pair counts under the one key that
its ``lcp`` names, never twice, and no pair is lost.

Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, A-Z lower-cased. If 31 divides
the CRC-32 ``h`` of ``<id>:<run>``, the run's code point ``h % length`` is deleted. Distinct
results with at least ``least_points`` code points and ``least_n`` occurrences are the vocabulary.
Each task counts in bounded memory before anything is shuffled.

Defined cases: null and empty texts have no words; a null id is the text of no characters before
the colon; repeated rows count again; very long texts are scanned match by match, very long runs
are words like others; ties for the most frequent near word go to the smallest in code-point order;
further columns of the documents are not read, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import utf8
from bazarlake.operators.workdir import materialize

LEAST_POINTS = 7
LEAST_N = 2
#: Of a word's form against the word itself.
RATIO = 10
MODULUS = 31
#: Words under one key beyond which the key is halved again; at least the alphabet's size.
CROWDED = 1024
#: Bounds of one block of the index: words, and letters in all.
_BLOCK_WORDS = 2048
_BLOCK_LETTERS = 1 << 20
_COUNTED = 200_000
_LONG_TEXT = 1 << 20

_KEY = ("long", "start", "zone", "prefix", "suffix")


# ---------------------------------------------------------------- vocabulary


def _runs_of(text: str, pattern: re.Pattern) -> Counter:
    if len(text) <= _LONG_TEXT:
        return Counter(pattern.findall(text))
    return Counter(match.group() for match in pattern.finditer(text))


def _as_counts(counts: dict[str, int]) -> pa.RecordBatch:
    words = pa.array(list(counts), pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_points: int = LEAST_POINTS, least_n: int = LEAST_N
) -> DataFrame:
    """(word, n): the vocabulary with its occurrences over all texts."""
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % least_points)  # shorter runs only get shorter

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for key, body in zip(batch.column("id"), batch.column("text"), strict=True):
                start = zlib.crc32(key.as_py().encode() + b":")
                for word, n in _runs_of(body.as_py().lower().decode(), pattern).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % MODULUS == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_points:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > _COUNTED:
                    yield _as_counts(counts)
                    counts = {}
        yield _as_counts(counts)

    own = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id")
    counted = docs.select(own, utf8(text).alias("text")).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


# ---------------------------------------------------------------- keys


def _halved(rows: DataFrame) -> DataFrame:
    """Each row under both keys of the halved open part ``[start, start + zone)``."""
    half = F.floor(F.col("zone") / 2).cast("int")
    first = F.struct((F.col("start") + half).alias("start"), (F.col("zone") - half).alias("zone"))
    last = F.struct(F.col("start").alias("start"), half.alias("zone"))
    parts = rows.select("word", "n", "long", F.explode(F.array(first, last)).alias("open"))
    end = F.col("long") - F.col("open.start") - F.col("open.zone")
    return parts.select(
        "word",
        "n",
        "long",
        "open.start",
        "open.zone",
        F.substr("word", F.lit(1), F.col("open.start")).alias("prefix"),
        F.substr("word", F.length("word") - end + 1, end).alias("suffix"),
    )


def keyed(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """The vocabulary under its keys, crowded ones halved until they are not or one letter is open."""
    points = F.length("word")
    whole = words.select("word", "n", F.explode(F.array(points, points + 1)).alias("long"))
    rows = _halved(whole.select("word", "n", "long", F.lit(0).alias("start"), F.col("long").alias("zone")))
    done = None
    while True:
        full = rows.filter("zone > 1").groupBy(*_KEY).agg(F.count("*").alias("words")).filter(F.col("words") > crowded)
        full = materialize(full.select(*_KEY))
        rest = rows.join(full, list(_KEY), "left_anti")
        done = rest if done is None else done.unionByName(rest)
        if full.isEmpty():
            return done
        rows = materialize(_halved(rows.join(full, list(_KEY), "left_semi").select("word", "n", "long", "start", "zone")))


# ---------------------------------------------------------------- index and recurrences


def _packed(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words; the columns are a multiple of 64."""
    return np.packbits(flags, axis=-1, bitorder="little").view("<u8")


def _near_sets(zones: list[str], short: np.ndarray, group: np.ndarray, zone: int) -> np.ndarray:
    """Bits (query, word): the words of the same key that are one edit from the query.

    All words have the same open part; ``short`` marks those with a letter less than the key's
    longer words. Their open part ends in the first letter of the common suffix, if there is one.
    """
    count = len(zones)
    width = -(-count // 64) * 64
    letters = np.zeros((count, zone), np.uint32)  # 0: no letter there
    for i, text in enumerate(zones):
        letters[i, : len(text)] = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    alphabet, codes = np.unique(letters, return_inverse=True)
    codes = codes.reshape(letters.shape)
    absent = np.flatnonzero(alphabet == 0)

    def at_position(j: int) -> np.ndarray:
        """The index at one position: a set of words per letter."""
        flags = np.zeros((len(alphabet), width), bool)
        if 0 <= j < zone:
            flags[codes[:, j], np.arange(count)] = True
            flags[absent] = False
        return _packed(flags)

    members = np.zeros((count, width), bool)
    members[:, :count] = group[:, None] == group[None, :]
    agree = _packed(members)
    flags = np.zeros(width, bool)
    flags[:count] = ~short
    longer = _packed(flags)
    flags[:count] = short
    shorter = _packed(flags)

    replaced, ahead, back = (np.zeros_like(agree) for _ in range(3))
    before, here, after = at_position(-1), at_position(0), at_position(1)
    for j in range(zone):
        own = codes[:, j]
        same = here[own]
        if j == zone - 1:
            by_short = ahead | agree  # a short query ends here; the word's letter may be the extra one
        back = agree | (back & before[own])
        ahead = (ahead | agree) & after[own]
        replaced = (replaced & same) | (agree & ~same)
        agree = agree & same
        before, here, after = here, after, at_position(j + 2)
    by_long = (replaced & longer) | (back & shorter)
    return np.where(short[:, None], by_short & longer, by_long) & ~agree


def _block(words: list[str], counts: list[int], zones: list[str], keys: list[str], short: list[bool], zone: int) -> pa.RecordBatch | None:
    """Near words of one block; bits are in order of preference, so the first bit is the best."""
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    numbers: dict[str, int] = {}
    group = np.array([numbers.setdefault(keys[i], len(numbers)) for i in order])
    near = _near_sets([zones[i] for i in order], np.array([short[i] for i in order]), group, zone)
    found = np.bitwise_count(near).sum(axis=1, dtype=np.int64)
    rows = np.flatnonzero(found)
    if not len(rows):
        return None
    first = (near[rows] != 0).argmax(axis=1)
    bits = near[rows, first]
    best = first * 64 + np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[order[i]] for i in rows.tolist()], pa.string()),
            pa.array(found[rows], pa.int64()),
            pa.array([words[order[i]] for i in best.tolist()], pa.string()),
            pa.array([counts[order[i]] for i in best.tolist()], pa.int64()),
        ],
        names=["word", "n_near", "near", "near_n"],
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by open part and key; whole keys are gathered to blocks."""
    held: list[tuple] = []
    begun, last = 0, None  # start of the last key in held; its name

    def flush(upto: int) -> Iterator[pa.RecordBatch]:
        if upto > 1:
            words, counts, zones, keys, short = (list(x) for x in zip(*[row[:5] for row in held[:upto]], strict=True))
            block = _block(words, counts, zones, keys, short, held[0][5])
            if block is not None:
                yield block
        del held[:upto]

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("word", "n", "open", "key", "short", "zone")]
        for row in zip(*columns, strict=True):
            if row[3] != last:
                full = len(held) >= _BLOCK_WORDS or len(held) * row[5] > _BLOCK_LETTERS
                if held and (full or row[5] != held[-1][5]):
                    yield from flush(len(held))
                elif len(held) - begun == 1:
                    held.pop()  # a key with one word
                begun, last = len(held), row[3]
            held.append(row)
    yield from flush(len(held))


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Per word with a near word: their number, and the most frequent of them with its count."""
    name = F.concat_ws(":", F.col("long"), F.col("start"), F.col("zone"), F.col("prefix"), F.col("suffix"))
    rows = keyed(words, crowded).select(
        "word",
        "n",
        F.substr("word", F.col("start") + 1, F.col("zone")).alias("open"),
        name.alias("key"),
        (F.length("word") < F.col("long")).alias("short"),
        "zone",
    )
    dealt = rows.repartition("zone", "key").sortWithinPartitions("zone", "key")
    found = dealt.mapInArrow(_compare, "word string, n_near bigint, near string, near_n bigint")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    per_word = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return per_word.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


# ---------------------------------------------------------------- forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms. Counts grow by ``RATIO`` a step, so rounds are few."""
    step = materialize(forms.select(F.col("word").alias("at"), F.col("form").alias("next")))
    reached = step.select(F.col("at").alias("word"), F.col("next").alias("root"))
    while True:
        moved = reached.join(step, reached.root == step.at, "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = materialize(moved)
        reached = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return reached


def grouped(words: DataFrame, ratio: int = RATIO, crowded: int = CROWDED) -> DataFrame:
    """Per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    kept = materialize(words.select("word", "n"))
    near = near_words(kept, crowded)
    judged = kept.join(near, "word", "left")
    enough = F.col("near_n") >= F.lit(ratio) * F.col("n")
    formed = materialize(
        judged.select(
            "word",
            F.when(enough, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("near_n")).alias("form_n"),
        )
    )
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The vocabulary of the documents with its spelling variants grouped under forms and roots."""
    return grouped(word_counts(docs, doc_id, text))
