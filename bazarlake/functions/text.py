"""Cleaning of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "not_available"


def normalize_text(name: str) -> Column:
    """Lower case, single blanks, no outer blanks; NULL becomes the empty string."""
    squeezed = F.regexp_replace(F.nvl(F.col(name).cast("string"), F.lit("")), r"\s+", " ")
    return F.lower(F.trim(squeezed)).alias(name)


def normalize_city(name: str) -> Column:
    """Normalised text with a capital at the start of each word."""
    return F.initcap(normalize_text(name)).alias(name)


def clean_id(name: str) -> Column:
    """Identifier without outer blanks."""
    return F.trim(name).alias(name)


def clean_state(name: str) -> Column:
    """State code without outer blanks, in capitals."""
    return F.upper(F.trim(name)).alias(name)


def zip5(name: str) -> Column:
    """Five-character postal prefix: drops a float tail, pads with zeros on the left.

    Longer input is cut to five characters and a blank gives ``00000``; only NULL stays NULL.
    """
    digits = F.regexp_replace(F.trim(name), r"\.0$", "")
    return F.lpad(digits, 5, "0").alias(name)


def is_blank(name: str) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(name, F.lit("")) == ""


def or_not_available(column: Column) -> Column:
    return F.coalesce(column, F.lit(NOT_AVAILABLE))
