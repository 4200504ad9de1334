"""Delivery times, lateness and satisfaction flags of an order.

The flags are three-valued: NULL means that the order cannot be judged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"
PURCHASED = "order_purchase_timestamp"
LOW_REVIEW_MAX = 2.0


def days_between(start: str, end: str) -> Column:
    """Days from start to end, two decimals, NULL if either is missing."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(SECONDS_PER_DAY), 2)


def _not_below_zero(days: Column) -> Column:
    # greatest() skips NULL, so an order without both dates needs the guard.
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0.0)))


def actual_delivery_days() -> Column:
    return days_between(PURCHASED, DELIVERED)


def delivery_delay_days() -> Column:
    return _not_below_zero(days_between(ESTIMATED, DELIVERED))


def delivery_early_days() -> Column:
    return _not_below_zero(days_between(DELIVERED, ESTIMATED))


def is_delivered() -> Column:
    return F.col("order_status") == "delivered"


def is_delivery_late() -> Column:
    return F.col(DELIVERED) > F.col(ESTIMATED)


def is_delivery_on_time() -> Column:
    return F.col(DELIVERED) <= F.col(ESTIMATED)


def is_low_review() -> Column:
    return F.col("review_score_avg") <= LOW_REVIEW_MAX


def date_key(name: str) -> Column:
    """Calendar day as the number yyyyMMdd."""
    day = F.to_date(name)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
