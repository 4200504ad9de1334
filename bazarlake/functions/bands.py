"""Labels for ranges of a measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazarlake.functions.text import NOT_AVAILABLE

# Exclusive upper edge and label, then the label above the last edge.
DISTANCE_EDGES = ((100, "under_100_km"), (500, "100_to_499_km"), (1000, "500_to_999_km"), (2000, "1000_to_1999_km"))
DISTANCE_TOP = "2000_km_or_more"
VALUE_EDGES = ((100, "under_100"), (300, "100_to_299"), (600, "300_to_599"))
VALUE_TOP = "600_or_more"
EARLY_DAYS_MIN = 3

# Seller risk limits, late percentage at or above, mean score below.
RISK_LIMITS = (("high", 20, 3.5), ("medium", 10, 4.0))
RISK_FLOOR = "low"

DISTANCE_ORDER = tuple(label for _, label in DISTANCE_EDGES) + (DISTANCE_TOP,)
RISK_ORDER = tuple(label for label, _, _ in RISK_LIMITS) + (RISK_FLOOR,)


def _ladder(steps: Sequence[tuple[Column, str]], top: str) -> Column:
    """First label whose test holds, else the top label (a NULL test does not hold)."""
    column = F
    for test, label in steps:
        column = column.when(test, F.lit(label))
    return column.otherwise(F.lit(top))


def distance_band(km: str = "seller_customer_distance_km") -> Column:
    value = F.col(km)
    steps = [(value.isNull(), NOT_AVAILABLE)] + [(value < edge, label) for edge, label in DISTANCE_EDGES]
    return _ladder(steps, DISTANCE_TOP)


def customer_value_band(gmv: str = "lifetime_gmv") -> Column:
    """A customer without any item value passes no edge and lands in the top band."""
    return _ladder([(F.col(gmv) < edge, label) for edge, label in VALUE_EDGES], VALUE_TOP)


def delivery_performance_band() -> Column:
    late = F.col("is_delivery_late")
    return _ladder(
        [
            (late.isNull(), "not_evaluated"),
            (late, "late"),
            (F.col("delivery_early_days") >= EARLY_DAYS_MIN, "early_3_days_or_more"),
        ],
        "on_time",
    )


def review_band(score: str = "review_score_avg") -> Column:
    """Only a mean of exactly 3 is neutral; 2.5 or 3.5 counts as high."""
    value = F.col(score)
    return _ladder([(value.isNull(), "not_reviewed"), (value <= 2, "low_1_2"), (value == 3, "neutral_3")], "high_4_5")


def service_risk_level(
    late_pct: str = "late_delivery_rate_pct", score: str = "avg_review_score"
) -> Column:
    """A seller without reviews and with few late orders is low risk."""
    return _ladder(
        [((F.col(late_pct) >= pct) | (F.col(score) < low), label) for label, pct, low in RISK_LIMITS],
        RISK_FLOOR,
    )


def position_in(labels: Sequence[str], column: str) -> Column:
    """1-based position of a label in a list, one past the end if it is not there."""
    steps = F
    for place, label in enumerate(labels, start=1):
        steps = steps.when(F.col(column) == label, F.lit(place))
    return steps.otherwise(F.lit(len(labels) + 1))
