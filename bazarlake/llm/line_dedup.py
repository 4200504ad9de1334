"""Line dedup by overlapping three-line windows.

Lines are the pieces between line feeds that hold a word; the others stay where they are and take
no part. Every run of three consecutive lines is hashed. A window that occurs more than once in
the corpus stays where it comes first, by (doc_id, hash of the text, place); at every later
occurrence its three lines go, and overlapping windows are merged by taking the set of their
places. Built-in expressions only.

Defined cases: null and empty texts, and texts of fewer than three lines, have no window and stay
as they are (a null text stays null). Rows that repeat both id and text are one document: they are
treated alike. Rows that share an id (or have none) but differ in text are told apart by the hash
of the text. An empty table gives an empty table. Columns of the input may have any name.

Skew: the first occurrence per window comes from a grouping that combines before the shuffle. Only
windows found twice or more are written, and joined back as plain exchanges, which AQE splits where
one window (a licence text) fills a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import WORD, let, row_of, text_or_empty
from bazarlake.operators.workdir import materialize

WINDOW = 3


def _lines(text: Column) -> Column:
    """(place among all lines, line) of the lines that hold a word."""
    pieces = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("place"), line.alias("line")))
    return F.filter(pieces, lambda x: x["line"].rlike(WORD))


def _windows(text: Column) -> Column:
    """(index of the first line, two 64-bit hashes) of every three consecutive lines."""

    def of_hashes(h: Column) -> Column:
        size = F.size(h)
        starts = F.when(size >= WINDOW, F.sequence(F.lit(0), size - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda i: F.struct(
                i.alias("start"),
                F.xxhash64(*[F.get(h, i + k)["a"] for k in range(WINDOW)]).alias("a"),
                F.xxhash64(*[F.get(h, i + k)["b"] for k in range(WINDOW)]).alias("b"),
            ),
        )

    hashes = F.transform(
        _lines(text),
        lambda x: F.struct(F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(1), x["line"]).alias("b")),
    )
    return let(hashes, of_hashes)


def _without(text: Column, covered: Column) -> Column:
    """The text without the lines (counted among those that hold a word) in ``covered``."""

    def kept(drop: Column) -> Column:
        def rest(pieces: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(pieces) - 1)
            return F.array_join(F.transform(F.array_except(places, drop), lambda i: F.get(pieces, i)), "\n")

        return let(F.split(text, "\n", -1), rest)

    places = let(_lines(text), lambda held: F.transform(covered, lambda i: F.get(held, i)["place"]))
    return let(places, kept)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``__row`` (all its columns), ``doc_id``, cleaned ``text``, ``n_lines``, ``n_removed``."""
    keyed = docs.select(
        row_of(docs).alias("__row"),
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    )
    windows = keyed.select("doc_id", "text_hash", F.explode(_windows(text_or_empty())).alias("w")).select(
        "doc_id", "text_hash", "w.*"
    )
    place = F.struct("doc_id", "text_hash", "start")
    repeated = materialize(
        windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").drop("last")
    )
    later = windows.join(repeated, ["a", "b"]).filter(~F.col("first").eqNullSafe(place))
    covered = (
        later.groupBy("doc_id", "text_hash")
        .agg(F.collect_set("start").alias("starts"))
        .select(
            F.col("doc_id").alias("__id"),
            F.col("text_hash").alias("__hash"),
            F.array_distinct(F.flatten(F.transform("starts", lambda i: F.array(*[i + k for k in range(WINDOW)])))).alias("covered"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    none = F.array().cast("array<int>")
    joined = keyed.join(covered, same, "left").withColumn("covered", F.coalesce("covered", none))
    return joined.select(
        "__row",
        "doc_id",
        F.when(F.size("covered") == 0, F.col("text")).otherwise(_without(F.col("text"), F.col("covered"))).alias("text"),
        F.size(_lines(text_or_empty())).cast("bigint").alias("n_lines"),
        F.size("covered").cast("bigint").alias("n_removed"),
    )


def report(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_lines", "n_removed", "text")


def cleaned(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows with the cleaned text and its length. A row that loses every line stays with an empty text."""
    done = deduplicated(docs, text=text)
    cells = {c: F.col("__row")[c] for c in docs.columns}
    cells[text] = F.col("text")
    if length in cells:
        cells[length] = F.when(F.col("n_removed") == 0, cells[length]).otherwise(F.length("text")).cast(docs.schema[length].dataType)
    return done.select(*[value.alias(name) for name, value in cells.items()])
