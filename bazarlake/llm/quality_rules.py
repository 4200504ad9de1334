"""Quality rules: one table of thresholds, compiled into one projection of the text.

Everything is built-in expressions over one row; nothing is shuffled. Counts of a text:

* words: runs of characters other than space, tab, line feed, vertical tab, form feed, return;
* lines: pieces between line feeds that hold a word; a duplicate equals an earlier one;
* repeated words: those inside a three-word window that occurs twice or more in the text.

Windows are compared by their 64-bit hash within one text. A null or empty text has no words and
fails the base rule; rows are never merged or dropped by :func:`measured`, so null ids, repeated
rows and an empty table need no special case. Columns of the input are kept by :func:`accepted`
and left out of :func:`measured`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazarlake.llm.common import SPACES, WORD, let, text_or_empty

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for with was as on by this are from at an be or "
    "der die das und in den von zu ist mit auf für ein eine des dem nicht sich im auch "
    "de la le les et des en un une du est que pour dans par sur qui pas au avec "
    "de la el en y que los las del se un una por con para es no al lo como"
).split()

MIN_WORDS = 50
REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``low * over <= 100 * value <= high * over`` in whole numbers; an open end is None."""

    name: str
    value: str
    over: str
    low: int | None = None
    high: int | None = None

    def broken(self, counts: Column) -> Column:
        value, over = F.lit(100) * counts[self.value], counts[self.over]
        checks = [value < self.low * over] * (self.low is not None) + [value > self.high * over] * (self.high is not None)
        out = checks[0]
        for more in checks[1:]:
            out = out | more
        return out


#: Percentages: mean word length in hundredths, symbols and stop words per word, line shares.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=30),
    Rule("stop_words", "n_stop_words", "n_words", low=1),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
    Rule("shouting_lines", "n_loud_lines", "n_lines", high=50),
)


def _repeated_words(words: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more."""

    def windows(w: Column) -> Column:
        triples = F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)),
        )
        return let(F.when(F.size(w) >= 3, triples).otherwise(F.array().cast("array<bigint>")), covered)

    def covered(hashes: Column) -> Column:
        repeated = let(
            F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            lambda s: F.filter(
                s,
                lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        places = F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        # Most texts repeat nothing; they skip the sort.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(F.size(F.array_distinct(places)))

    return let(words, windows)


def _counts(text: Column, stop_words: tuple[str, ...]) -> Column:
    """One struct of all counts of a text."""
    stops = sorted(set(stop_words))

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))

        def of_lines(held: Column) -> Column:
            return F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
                (F.size(held) - F.size(F.array_distinct(held))).cast("bigint").alias("n_dup_lines"),
                _repeated_words(words).cast("bigint").alias("n_repeat_words"),
                F.size(F.filter(words, lambda w: F.lower(w).isin(stops))).cast("bigint").alias("n_stop_words"),
                F.size(held).cast("bigint").alias("n_lines"),
                F.size(F.filter(held, lambda line: (line == F.upper(line)) & (line != F.lower(line)))).cast("bigint").alias("n_loud_lines"),
            )

        return let(lines, of_lines)

    return let(F.array_remove(F.split(text, SPACES), ""), of_words)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _verdict(counts: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(base rule failed, names of the broken rules)."""
    base = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > REPEATED_PERCENT * counts["n_words"])
    broken = F.array_compact(F.array(*[F.when(rule.broken(counts), F.lit(rule.name)) for rule in rules]))
    return base, broken


def _with_counts(docs: DataFrame, text: str, stop_words: tuple[str, ...], *kept: Column) -> DataFrame:
    return docs.select(*kept, _counts(text_or_empty(text), stop_words).alias("__counts"))


def measured(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    stop_words: tuple[str, ...] = tuple(STOP_WORDS),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: id, counts, ``base_failed``, ``kept`` and the names of the ``broken_rules``."""
    counts = F.col("__counts")
    base, broken = _verdict(counts, rules)
    return _with_counts(docs, text, stop_words, F.col(doc_id).alias("doc_id")).select(
        "doc_id",
        *[counts[c].alias(c) for c in COUNTS],
        base.alias("base_failed"),
        (~base & (F.size(broken) == 0)).alias("kept"),
        broken.alias("broken_rules"),
    )


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, stop_words: tuple[str, ...] = tuple(STOP_WORDS), text: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns.

    The verdict is one expression that holds the counts once: a filter on columns made from them
    would be pushed below the projection and repeat the counting for each of its terms.
    """

    def passed(counts: Column) -> Column:
        base, broken = _verdict(counts, rules)
        return ~base & (F.size(broken) == 0)

    return docs.filter(let(_counts(text_or_empty(text), stop_words), passed))
