"""Silver tables: typed, cleaned and enriched rows of one bronze table each.

Every function is DataFrame in, DataFrame out, in one projection.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions import bands, dates, money, text
from tillwright.functions.casting import typed_columns
from tillwright.schemas import silver_types
from tillwright.sources.flat_files import drop_provenance

AsOf = datetime.date | str | None


def _refined(df: DataFrame, table: str, cleaned: dict | None = None, **derived: Column) -> DataFrame:
    """Types of the table, then `cleaned` over the typed columns, then the `derived` columns."""
    rows = drop_provenance(df)
    changed = typed_columns(rows, silver_types(table))
    for name, clean in (cleaned or {}).items():
        changed[name] = clean(changed.get(name, F.col(name)))
    return rows.withColumns(changed).withColumns(derived)


def silver_customer(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _refined(
        df,
        "customer_dim",
        cleaned={
            "full_name": text.proper_case,
            "email": text.clean_lower,
            "country": text.clean_upper,
        },
        age_band=bands.age_band(F.col("age")),
        tenure_years=dates.years_since(F.col("join_date"), dates.as_of_date(as_of)),
    )


def silver_item(df: DataFrame) -> DataFrame:
    price = F.col("unit_price")
    return _refined(
        df,
        "item_dim",
        margin_pct=money.margin_percent(price, F.col("cost_price")),
        price_band=bands.price_band(price),
    )


def silver_store(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    return _refined(
        df,
        "store_dim",
        store_age_years=dates.years_since(F.col("open_date"), dates.as_of_date(as_of)),
    )


def silver_calendar(df: DataFrame) -> DataFrame:
    return _refined(df, "time_dim")


def silver_transactions(
    df: DataFrame, cost_factor: str | float = money.STANDARD_COST_FACTOR
) -> DataFrame:
    """Refunded and pending lines stay in; later layers decide what they count."""
    profit = money.line_profit(
        F.col("net_amount"), F.col("quantity"), F.col("unit_price"), cost_factor
    )
    return _refined(df, "transactions", profit_amount=profit)
