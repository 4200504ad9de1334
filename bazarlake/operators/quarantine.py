"""Split rows into valid and rejected ones by one shared list of rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: separator of several reasons in one row.
REASON_SEPARATOR = "; "

Rule = tuple[str, Column]


def is_bad(rules: Sequence[Rule]) -> Column:
    """True if any rule rejects the row. Rules never give NULL, so NOT is the valid side."""
    return reduce(or_, (test for _, test in rules))


def reasons(rules: Sequence[Rule]) -> Column:
    return F.concat_ws(REASON_SEPARATOR, *[F.when(test, F.lit(text)) for text, test in rules])


def accepted(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(~is_bad(rules))


def rejected(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(is_bad(rules)).withColumn("quarantine_reason", reasons(rules))


# Values of the verdict column, by which a judged table is partitioned.
VERDICT, ACCEPTED, REJECTED = "verdict", "accepted", "rejected"


def judged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every row with its reasons and verdict, for one write that holds both sides.

    The rules are evaluated once: a row without a reason is accepted.
    """
    marked = df.withColumn("quarantine_reason", F.nullif(reasons(rules), F.lit("")))
    verdict = F.when(F.col("quarantine_reason").isNull(), ACCEPTED).otherwise(REJECTED)
    return marked.withColumn(VERDICT, verdict)


def accepted_side(judged_rows: DataFrame) -> DataFrame:
    """Read from a table partitioned by verdict, this prunes the rejected files."""
    return judged_rows.filter(F.col(VERDICT) == ACCEPTED).drop(VERDICT, "quarantine_reason")


def rejected_side(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.filter(F.col(VERDICT) == REJECTED).drop(VERDICT)
