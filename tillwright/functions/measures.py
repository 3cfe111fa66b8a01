"""Aggregates of the gold tables. Sums run on exact decimals and leave as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.functions.money import ratio


def total(column: str) -> Column:
    return F.sum(column).cast("double")


def mean(column: str) -> Column:
    return ratio(F.sum(column), F.count(column))


def different(column: str) -> Column:
    """Number of different values, null not counted, for columns of few values: each group keeps its set.

    Unlike a distinct count it needs no shuffle by the values besides the one by the groups.
    """
    return F.size(F.collect_set(column)).cast("long")


def flagged(column: str) -> Column:
    """Rows whose flag is set; null, not zero, for a group that has no flag at all."""
    return F.sum(F.col(column).cast("int"))
