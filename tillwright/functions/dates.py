"""Calendar expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def as_of_date(as_of: datetime.date | str | None) -> Column:
    """The reference day of recency and tenure: a fixed date, or the day the job runs."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def years_since(start: Column, as_of: Column) -> Column:
    """Years from `start` to `as_of`, to one decimal."""
    return F.round(days_between(as_of, start) / F.lit(DAYS_PER_YEAR), 1)


def date_key(day: Column) -> Column:
    """Integer key of a day: 2001-08-02 gives 20010802."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def is_fixed_holiday(day: Column) -> Column:
    # Christmas Day and New Year's Day.
    return F.date_format(day, "MM-dd").isin("12-25", "01-01")


def fiscal_quarter(day: Column) -> Column:
    return F.format_string("FY%dQ%d", F.year(day), F.quarter(day))


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")
