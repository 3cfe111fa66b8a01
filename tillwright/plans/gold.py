"""Gold tables: the sales fact joined with its dimensions, and three summaries of it."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions import bands, dates, money
from tillwright.functions.measures import different, flagged, mean, total
from tillwright.operators.audit import preview
from tillwright.operators.joins import attach, fits_broadcast, hot_in_tables, salted_join, scanned_bytes

# What the fact takes from each dimension, by the key it joins on.
ATTRIBUTES = {
    "customer_id": ("full_name", "city", "state", "loyalty_tier", "age_band", "gender"),
    "item_id": ("item_name", "category", "sub_category", "price_band"),
    "store_id": ("store_name", "store_type", "region"),
    "date_id": (
        "full_date", "day_name", "month_name", "month", "quarter", "year",
        "is_weekend", "is_holiday",
    ),
}
# Columns of the gold tables.
KEYS = ("transaction_id", "customer_id", "item_id", "store_id", "date_id")
MEASURES = (
    "quantity", "unit_price", "discount_pct", "discount_amount", "gross_amount",
    "net_amount", "tax_amount", "total_amount", "profit_amount",
)
LABELS = ("payment_method", "channel", "return_flag", "transaction_status")

DAILY_KEYS = ("full_date", "year", "month", "month_name", "quarter", "is_weekend")
CATEGORY_KEYS = ("category", "sub_category", "price_band")
CUSTOMER_KEYS = ("customer_id", *ATTRIBUTES["customer_id"])


#: Most parts that a large fact is joined in, for each shuffled join, and bytes of stored lines of a part at least.
PARTS = 6
PART_BYTES = 128 * 1024 * 1024


def star_join(
    txns: DataFrame, dimensions: dict[str, DataFrame], key_tables: Mapping[str, DataFrame] | None = None,
    more: Sequence[str] = (), hot: Mapping[str, dict] | None = None,
) -> DataFrame:
    """Sales lines with the attributes of the given dimensions, keyed by join column.

    Every line stays, with null attributes where a key has no dimension row. Hot keys of
    dimensions too large to broadcast are looked for in `key_tables`, the tables that hold the key
    columns before any join; without them in `txns`, which should then be a stored table. A query over
    the fact may leave out dimensions it takes nothing from, provided their keys are unique. `more` names
    further columns of the lines to keep; `hot` gives hot keys found before.
    """
    fact = txns.select(*KEYS, *MEASURES, *LABELS, *more)
    large = large_keys(dimensions)
    if hot is None:
        hot = _hot(txns, large, key_tables)
    # Shuffled joins come first, while the rows are narrow; items before customers, so that a task's rows, and
    # a file of the stored fact, have all lines of few customers and sum up well by customer. Stores and days,
    # where their size is not known, come after, for then adaptive execution can still broadcast them.
    for key in sorted(dimensions, key=lambda k: (k not in large, k in ("store_id", "date_id"), k == "customer_id")):
        lookup = dimensions[key].select(key, *ATTRIBUTES[key])
        if key in large:
            fact = salted_join(fact, lookup, key, "left", hot[key])
        else:
            fact = fact.join(F.broadcast(lookup), key, "left")
    attributes = [c for key in ATTRIBUTES if key in dimensions for c in ATTRIBUTES[key]]
    return fact.select(*KEYS, *attributes, *MEASURES, *LABELS, *more)


def large_keys(dimensions: Mapping[str, DataFrame]) -> list[str]:
    return [k for k, df in dimensions.items() if not fits_broadcast(df)]


def _hot(txns: DataFrame, large: Sequence[str], key_tables: Mapping[str, DataFrame] | None) -> dict[str, dict]:
    return hot_in_tables({k: (key_tables or {}).get(k, txns) for k in large})


def star_join_parts(
    txns: DataFrame, dimensions: dict[str, DataFrame], key_tables: Mapping[str, DataFrame] | None = None,
    more: Sequence[str] = (),
) -> list[DataFrame]:
    """The rows of :func:`star_join` in parts, to be written one after the other.

    A shuffled join of all lines holds them on disk once for each large dimension, at several times their stored
    size; a part holds its own only, and its files go before the next one (see :func:`session.tidy`). Parts are
    dealt by a large key, customers before others, so that all lines of one are in the same part. `txns` is read
    once a part and should be a stored table. Without a large dimension, or with few lines, there is one part.
    """
    large = large_keys(dimensions)
    stored = scanned_bytes(txns) or 0
    count = max(1, min(PARTS * len(large), stored // PART_BYTES))
    hot = _hot(txns, large, key_tables)
    if count == 1:
        return [star_join(txns, dimensions, more=more, hot=hot)]
    key = "customer_id" if "customer_id" in large else large[0]
    part = F.pmod(F.xxhash64(key), F.lit(count))
    return [star_join(txns.where(part == i), dimensions, more=more, hot=hot) for i in range(count)]


# The table behind each key, by the names of the quality rules.
DIMENSION_OF = {"customer_id": "customers", "item_id": "items", "store_id": "stores", "date_id": "calendar"}


def gold_fact_sales(
    txns: DataFrame, customers: DataFrame, items: DataFrame, stores: DataFrame, calendar: DataFrame,
    key_tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One wide row per sales line."""
    dimensions = {
        "customer_id": customers, "item_id": items, "store_id": stores, "date_id": calendar
    }
    return star_join(txns, dimensions, key_tables)


def _with_customers(fact: DataFrame, keys: Sequence[str], stored: bool, *sums: Column | str) -> DataFrame:
    """Groups with their sums and, where "unique_customers" stands among these, the number of customers.

    A `stored` fact is read twice: sums combine to a row per group before their shuffle, and only keys and
    customers are made different. Else each sum would be shuffled once per group and customer. A computed fact
    is gone through once.
    """
    name = "unique_customers"
    if not stored:
        return fact.groupBy(*keys).agg(*[F.count_distinct("customer_id").alias(name) if isinstance(s, str) else s for s in sums])
    summed = fact.groupBy(*keys).agg(*[s for s in sums if not isinstance(s, str)])
    pairs = fact.where("customer_id is not null").select(*[F.col(k).alias(f"_{k}") for k in keys], "customer_id").distinct()
    counted = pairs.groupBy(*[f"_{k}" for k in keys]).agg(F.count(F.lit(1)).alias(name))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = summed.join(counted, same, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    at = [isinstance(s, str) for s in sums].index(True)
    ordered = summed.columns[:len(keys) + at] + [name] + summed.columns[len(keys) + at:]
    return joined.select(*ordered)


def gold_sales_daily(fact: DataFrame, stored: bool = False) -> DataFrame:
    return (
        _with_customers(
            fact, DAILY_KEYS, stored,
            F.count("transaction_id").alias("transaction_count"),
            total("total_amount").alias("total_revenue"),
            total("profit_amount").alias("total_profit"),
            F.sum("quantity").alias("total_units_sold"),
            mean("total_amount").alias("avg_order_value"),
            "unique_customers",
            flagged("return_flag").alias("return_count"),
            total("discount_amount").alias("total_discounts"),
        )
        .withColumns({
            "profit_margin_pct": money.percent(F.col("total_profit"), F.col("total_revenue")),
            "return_rate_pct": money.percent(F.col("return_count"), F.col("transaction_count")),
        })
        .orderBy("full_date")
    )


def gold_sales_by_category(fact: DataFrame, stored: bool = False) -> DataFrame:
    """The rank orders the few category rows of the aggregate, never sales lines."""
    by_revenue = Window.orderBy(F.desc("total_revenue"))
    return (
        _with_customers(
            fact, CATEGORY_KEYS, stored,
            total("total_amount").alias("total_revenue"),
            total("profit_amount").alias("total_profit"),
            F.sum("quantity").alias("units_sold"),
            F.count("transaction_id").alias("transaction_count"),
            mean("total_amount").alias("avg_order_value"),
            mean("discount_pct").alias("avg_discount_pct"),
            "unique_customers",
        )
        .withColumn(
            "profit_margin_pct", money.percent(F.col("total_profit"), F.col("total_revenue"))
        )
        .withColumn("revenue_rank", F.rank().over(by_revenue))
        .orderBy("revenue_rank")
    )


def gold_customer_summary(
    fact: DataFrame,
    as_of: datetime.date | str | None = None,
    thresholds: bands.SegmentThresholds = bands.SegmentThresholds(),
) -> DataFrame:
    """Recency, frequency and spend per customer; orders are counted as sales lines."""
    return with_segment(_customer_sums(fact, CUSTOMER_KEYS), as_of, thresholds)


def gold_customer_summary_of(
    fact: DataFrame, customers: DataFrame, as_of: datetime.date | str | None = None,
    thresholds: bands.SegmentThresholds = bands.SegmentThresholds(),
) -> DataFrame:
    """The same over a fact without customer attributes: sums per customer, then one row of each is joined.

    Only for customers whose key is unique.
    """
    sums = _customer_sums(fact, ("customer_id",))
    # One row per customer is left, so no key is hot.
    named = attach(sums, customers.select(*CUSTOMER_KEYS), "customer_id", "left", hot={})
    ordered = [*CUSTOMER_KEYS, *[c for c in sums.columns if c != "customer_id"]]
    return with_segment(named.select(*ordered), as_of, thresholds)


def _customer_sums(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count("transaction_id").alias("total_orders"),
        total("total_amount").alias("total_spend"),
        mean("total_amount").alias("avg_order_value"),
        F.max("full_date").alias("last_purchase_date"),
        F.min("full_date").alias("first_purchase_date"),
        F.sum("quantity").alias("total_units"),
        flagged("return_flag").alias("total_returns"),
        different("category").alias("categories_bought"),
    )


def with_segment(summary: DataFrame, as_of, thresholds: bands.SegmentThresholds) -> DataFrame:
    last, first = F.col("last_purchase_date"), F.col("first_purchase_date")
    return summary.withColumns({
        "days_since_purchase": dates.days_between(dates.as_of_date(as_of), last),
        "customer_tenure_days": dates.days_between(last, first),
        "return_rate_pct": money.percent(F.col("total_returns"), F.col("total_orders")),
    }).withColumn(
        "rfm_segment",
        bands.customer_segment(
            F.col("total_orders"), F.col("total_spend"), F.col("days_since_purchase"), thresholds
        ),
    )


def top_categories(category: DataFrame, count: int = 5) -> DataFrame:
    """The best categories of the category table."""
    shown = ["category", "total_revenue", "profit_margin_pct", "units_sold"]
    return preview(category, ["revenue_rank", *CATEGORY_KEYS], count, shown)
