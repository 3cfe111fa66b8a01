"""The calendar dimension: one row per day."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions import dates


def calendar_between(
    spark: SparkSession, start: datetime.date | str | None, end: datetime.date | str | None
) -> DataFrame:
    """Calendar of a fixed range of days, both ends included; empty without bounds.

    The days come from a range whose length the plan knows, so a join can tell whether the
    calendar is small enough to broadcast, however far apart the ends lie.
    """
    count = 0
    if start is not None and end is not None:
        first, last = (datetime.date.fromisoformat(str(d)) for d in (start, end))
        count = max(0, (last - first).days + 1)
    day = F.col("full_date")
    days = spark.range(count).select(
        F.date_add(F.lit(str(start)).cast("date"), F.col("id").cast("int")).alias("full_date")
    )
    return days.select(
        dates.date_key(day).alias("date_id"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week_of_year"),
        dates.iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        dates.yes_no(dates.is_weekend(day)).alias("is_weekend"),
        dates.yes_no(dates.is_fixed_holiday(day)).alias("is_holiday"),
        dates.fiscal_quarter(day).alias("fiscal_quarter"),
    )


def calendar_over(bounds: DataFrame) -> DataFrame:
    """Calendar from the one row `(start, end)` of `bounds`, which is read right away."""
    start, end = bounds.select("start", "end").first() or (None, None)
    return calendar_between(bounds.sparkSession, start, end)
