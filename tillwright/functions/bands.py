"""Labels for value ranges and customer segments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound (exclusive) and label of each band, then the label beyond.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
AGE_BAND_BEYOND = "55+"
PRICE_BANDS = ((25, "Budget"), (100, "Mid-Range"), (300, "Premium"))
PRICE_BAND_BEYOND = "Luxury"


def band(value: Column, steps: Sequence[tuple[float, str]], beyond: str) -> Column:
    """Label of the first step whose bound lies above `value`; null takes the last label."""
    nested = F.lit(beyond)
    for bound, label in reversed(steps):
        nested = F.when(value < bound, label).otherwise(nested)
    return nested


def age_band(age: Column) -> Column:
    return band(age, AGE_BANDS, AGE_BAND_BEYOND)


def price_band(price: Column) -> Column:
    return band(price, PRICE_BANDS, PRICE_BAND_BEYOND)


@dataclass(frozen=True)
class SegmentThresholds:
    """Bounds of the customer segments, all inclusive but `lapsed_days`."""

    # The standard bounds.
    champion_orders: int = 5
    champion_spend: float = 500
    loyal_orders: int = 3
    loyal_days: int = 60
    lapsed_days: int = 180


def customer_segment(
    orders: Column, spend: Column, recency_days: Column, at: SegmentThresholds
) -> Column:
    """First rule that holds, in the order written; a null recency meets no recency rule."""
    rules = [
        ("Champion", [orders >= at.champion_orders, spend >= at.champion_spend]),
        ("Loyal", [orders >= at.loyal_orders, recency_days <= at.loyal_days]),
        ("At Risk", [recency_days > at.lapsed_days]),
    ]
    label = F.lit("Regular")
    for name, conditions in reversed(rules):
        label = F.when(reduce(Column.__and__, conditions), name).otherwise(label)
    return label
