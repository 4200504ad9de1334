"""Means and percentages that do not depend on the order of summation.

Money, day counts, scores and kilometres all have two decimals, so they are summed as whole
hundredths (bigint, hash aggregation) and rounded once, half up, from the exact quotient. A sum
of doubles would change its last digit with the shuffle order, and so flip a rounding tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazarlake.functions.typed import MONEY

_WHOLE = "decimal(20,0)"


def hundredths(column: Column) -> Column:
    """Whole hundredths of a two-decimal number."""
    return F.rint(column * 100).cast("bigint")


def _quotient(total: Column, count: Column, digits: int) -> Column:
    # decimal(20,0) by decimal(20,0) keeps 18 decimals: exact enough for any row count.
    return F.round(F.try_divide(total.cast(_WHOLE), count.cast(_WHOLE)), digits)


def mean2(name: str) -> Column:
    """Mean of a two-decimal column, two decimals, as double."""
    column = F.col(name)
    return (_quotient(F.sum(hundredths(column)), F.count(column), 0) / 100).cast("double")


def mean2_money(name: str) -> Column:
    """Mean of a money column, two decimals, as money."""
    column = F.col(name)
    cents = (column * 100).cast("bigint")
    return (_quotient(F.sum(cents), F.count(column), 0) / 100).cast(MONEY)


def mean_parts(name: str, money: bool = False) -> dict[str, Column]:
    """The two sums of a mean, for a grouping that is summed once more."""
    column = F.col(name)
    cents = (column * 100).cast("bigint") if money else hundredths(column)
    return {f"__{name}_sum": F.sum(cents), f"__{name}_rows": F.count(column)}


def mean_of_parts(name: str, money: bool = False) -> Column:
    """The mean from the summed parts, as ``mean2`` or ``mean2_money`` gives it."""
    mean = _quotient(F.col(f"__{name}_sum"), F.col(f"__{name}_rows"), 0) / 100
    return mean.cast(MONEY if money else "double")


def percent_of(hits: Column, total: Column) -> Column:
    return _percent(hits, total)


def _percent(hits: Column, total: Column) -> Column:
    return (_quotient(hits * 10000, total, 0) / 100).cast("double")


def rate_pct(condition: Column) -> Column:
    """Percentage of all rows where the condition is true; NULL counts as false."""
    return _percent(F.count_if(condition), F.count(F.lit(1)))


def tristate_rate_pct(condition: Column) -> Column:
    """Percentage of true among the rows where the condition is true or false."""
    return _percent(F.count_if(condition), F.count(condition))


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """part of whole in percent, NULL for an empty whole."""
    scaled = _quotient(part.cast(_WHOLE) * 100, whole, digits)
    return scaled.cast("double")


def freight_ratio(price: str = "price", freight: str = "freight_value") -> Column:
    """Freight by price, NULL for a price of zero."""
    return F.when(F.col(price) > 0, F.try_divide(F.col(freight), F.col(price)))
