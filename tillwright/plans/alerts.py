"""Days whose revenue stays below a target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def days_below(daily: DataFrame, target: float) -> DataFrame:
    return (
        daily.where(F.col("total_revenue") < target)
        .select("full_date", "total_revenue")
        .withColumns({
            "target": F.lit(float(target)),
            "shortfall": F.round(F.lit(float(target)) - F.col("total_revenue"), 2),
        })
    )
