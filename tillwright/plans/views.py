"""Reporting views over the sales fact, and the queries asked of them.

A view is its grouping columns plus named measures from one catalogue, so that "revenue" is
written down once. The SQL text made from it serves temporary views, catalog views and
DataFrames alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.functions.money import half_up, ratio

FACT = "gold_fact_sales"


def _total(column: str) -> str:
    return f"ROUND(CAST(SUM({column}) AS DOUBLE), 2)"


def _half_up(value: str, digits: int) -> str:
    return f"ROUND(CAST({value} AS DOUBLE), {digits})"


def _ratio(part: str, whole: str, scale: int = 1, digits: int = 2) -> str:
    value = f"TRY_DIVIDE(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"
    return _half_up(value if scale == 1 else f"{value} * {scale}", digits)


@dataclass(frozen=True)
class DistinctCount:
    """Number of different values of a column, null not counted."""

    column: str

    def in_one_pass(self) -> str:
        return f"COUNT(DISTINCT {self.column})"

    def per_group(self, source: str, keys: tuple[str, ...]) -> str:
        """A row per group: the keys and the number, as `different`."""
        shown = ", ".join(keys)
        return (
            f"(SELECT {shown}, COUNT(*) AS different FROM (SELECT DISTINCT {shown}, {self.column} FROM {source} "
            f"WHERE {self.column} IS NOT NULL) GROUP BY {shown})"
        )

    def on_its_own(self, source: str) -> str:
        """One narrow shuffle of the column, at the price of reading it again."""
        column = self.column
        return (
            f"(SELECT COUNT(*) FROM (SELECT DISTINCT {column} FROM {source} "
            f"WHERE {column} IS NOT NULL))"
        )


REVENUE = _total("total_amount")
PROFIT = _total("profit_amount")
UNITS = "SUM(quantity)"
SALES = DistinctCount("transaction_id")
CUSTOMERS = DistinctCount("customer_id")
STORES = DistinctCount("store_id")
AVERAGE_SALE = _ratio("SUM(total_amount)", "COUNT(total_amount)")
AVERAGE_DISCOUNT = _ratio("SUM(discount_pct)", "COUNT(discount_pct)", 100, 1)
MARGIN = _ratio("SUM(profit_amount)", "SUM(total_amount)", 100)
RETURNS = "SUM(CAST(return_flag AS INT))"
RETURN_RATE = _ratio(RETURNS, "COUNT(*)", 100)
LAST_PURCHASE = "MAX(full_date)"


@dataclass(frozen=True)
class View:
    keys: tuple[str, ...]
    measures: dict[str, str | DistinctCount]
    order: tuple[str, ...] = ()
    limit: int | None = None

    def sql(self, source: str = FACT, stored: bool = True) -> str:
        """The view over `source`.

        Several distinct counts in one aggregate multiply every row of the source. Where the source is
        a `stored` table, each of them therefore reads its one column, and the keys, for itself; a source
        that has to be computed is gone through once.
        """
        counts = {name: measure for name, measure in self.measures.items() if isinstance(measure, DistinctCount)}
        if stored and self.keys and len(counts) > 1:
            return self._counted_apart(source, counts)
        columns = list(self.keys)
        for name, measure in self.measures.items():
            if isinstance(measure, DistinctCount):
                apart = stored and not self.keys
                measure = measure.on_its_own(source) if apart else measure.in_one_pass()
            columns.append(f"{measure} AS {name}")
        parts = [f"SELECT {', '.join(columns)}", f"FROM {source}"]
        if self.keys:
            parts.append(f"GROUP BY {', '.join(self.keys)}")
        return "\n".join([*parts, *self._tail()])

    def _counted_apart(self, source: str, counts: dict[str, DistinctCount]) -> str:
        """The sums of each group joined with its distinct counts; a null in a key is a group, too."""
        keys = ", ".join(self.keys)
        sums = {name: measure for name, measure in self.measures.items() if name not in counts}
        columns = [f"sums.{key}" for key in self.keys] + [
            f"COALESCE(_{name}.different, 0) AS {name}" if name in counts else f"sums.{name}" for name in self.measures
        ]
        parts = [
            f"SELECT {', '.join(columns)}",
            f"FROM (SELECT {', '.join([keys, *[f'{m} AS {name}' for name, m in sums.items()]])} FROM {source} GROUP BY {keys}) AS sums",
        ]
        for name, count in counts.items():
            same = " AND ".join(f"sums.{key} <=> _{name}.{key}" for key in self.keys)
            parts.append(f"LEFT JOIN {count.per_group(source, self.keys)} AS _{name} ON {same}")
        return "\n".join([*parts, *self._tail()])

    def _tail(self) -> list[str]:
        parts = [f"ORDER BY {', '.join(self.order)}"] if self.order else []
        return parts if self.limit is None else [*parts, f"LIMIT {self.limit}"]

    def over(self, fact: DataFrame, stored: bool = False) -> DataFrame:
        return fact.sparkSession.sql(self.sql("{fact}", stored), fact=fact)


# Names and columns of the published views.
VIEWS = {
    "vw_executive_kpis": View((), {
        "total_transactions": SALES, "unique_customers": CUSTOMERS, "total_revenue": REVENUE,
        "total_profit": PROFIT, "avg_order_value": AVERAGE_SALE, "total_units_sold": UNITS,
        "profit_margin_pct": MARGIN, "total_returns": RETURNS, "return_rate_pct": RETURN_RATE,
    }),
    "vw_revenue_by_category": View(("category",), {
        "total_revenue": REVENUE, "total_profit": PROFIT, "units_sold": UNITS,
        "transactions": SALES, "unique_customers": CUSTOMERS,
        "avg_discount_pct": AVERAGE_DISCOUNT, "margin_pct": MARGIN,
    }),
    "vw_monthly_trend": View(("year", "month", "month_name"), {
        "monthly_revenue": REVENUE, "monthly_profit": PROFIT, "order_count": SALES,
        "active_customers": CUSTOMERS, "avg_order_value": AVERAGE_SALE, "units_sold": UNITS,
    }),
    "vw_top_customers": View(
        ("customer_id", "full_name", "city", "state", "loyalty_tier", "age_band"),
        {
            "total_spend": REVENUE, "total_orders": SALES, "avg_order_value": AVERAGE_SALE,
            "last_purchase_date": LAST_PURCHASE,
        },
        # The key makes the cut at the limit the same on every run.
        order=("total_spend DESC", "customer_id", "full_name", "city", "state", "loyalty_tier",
               "age_band"),
        limit=50,
    ),
    "vw_store_performance": View(("store_id", "store_name", "store_type", "region"), {
        "total_revenue": REVENUE, "total_profit": PROFIT, "transaction_count": SALES,
        "unique_customers": CUSTOMERS, "avg_order_value": AVERAGE_SALE, "margin_pct": MARGIN,
    }),
}

_CHANNEL = View(("channel",), {
    "orders": SALES, "revenue": REVENUE, "avg_order_value": AVERAGE_SALE,
})
_WEEKEND = View(("is_weekend",), {
    "transactions": SALES, "total_revenue": REVENUE, "avg_order_value": AVERAGE_SALE,
})
_LOYALTY = View(("loyalty_tier",), {
    "customers": CUSTOMERS, "revenue": REVENUE, "avg_order_value": AVERAGE_SALE,
    "_exact": "SUM(total_amount)",
})
_TOP_ITEMS = View(
    ("item_name", "category"),
    {"units_sold": UNITS, "revenue": REVENUE, "avg_discount_pct": AVERAGE_DISCOUNT},
    order=("revenue DESC", "item_name", "category"),
    limit=10,
)
_REGION = View(("region",), {
    "store_count": STORES, "total_revenue": REVENUE, "customers": CUSTOMERS,
    "avg_order_value": AVERAGE_SALE,
})


def top_customers_of(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Top customers over a fact without customer attributes: only the customers left are joined.

    Only for customers whose key is unique; then the key alone breaks ties.
    """
    view = VIEWS["vw_top_customers"]
    best = View(("customer_id",), view.measures, ("total_spend DESC", "customer_id"), view.limit)
    ranked = best.over(fact)
    rows = ranked.collect()  # `limit` rows at most
    found = fact.sparkSession.createDataFrame(rows, ranked.schema)
    named = customers.select(*view.keys).where(F.col("customer_id").isin([r["customer_id"] for r in rows]))
    joined = found.join(named, "customer_id", "left").select(*view.keys, *view.measures)
    return joined.orderBy(F.desc("total_spend"), "customer_id")


def create_temp_views(fact: DataFrame, stored: bool = False) -> None:
    """The views as temporary views of the session, over any DataFrame of the fact."""
    for name, view in VIEWS.items():
        view.over(fact, stored).createOrReplaceTempView(name)


def create_catalog_views(spark: SparkSession, database: str, fact_table: str = FACT) -> None:
    """The views as lasting views of the catalog, over the written fact table."""
    for name, view in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {view.sql(f'{database}.{fact_table}')}")


def kpi_summary(kpis: DataFrame) -> DataFrame:
    return kpis.select("*")


def best_categories(by_category: DataFrame, count: int = 5) -> DataFrame:
    return (
        by_category.orderBy(F.desc("total_revenue"), "category")
        .limit(count)
        .select("category", "total_revenue", "margin_pct", "units_sold")
    )


def monthly_growth(trend: DataFrame) -> DataFrame:
    """Change against the previous month present. The window orders months, not sales lines."""
    previous = F.lag("monthly_revenue").over(Window.orderBy("year", "month"))
    change = F.col("monthly_revenue") - F.col("prev_month_revenue")
    return (
        trend.select("year", "month", "month_name", "monthly_revenue")
        .withColumn("prev_month_revenue", previous)
        .withColumn("mom_growth_pct", half_up(ratio(change, F.col("prev_month_revenue")) * 100, 1))
        .orderBy("year", "month")
    )


def revenue_by_channel(fact: DataFrame) -> DataFrame:
    return _CHANNEL.over(fact).orderBy(F.desc("revenue"), "channel")


def weekend_split(fact: DataFrame) -> DataFrame:
    """Grouped on the flag itself, so rows without a calendar day form a second weekday row."""
    label = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return _WEEKEND.over(fact).select(
        label.alias("day_type"), "transactions", "total_revenue", "avg_order_value"
    )


def loyalty_breakdown(fact: DataFrame) -> DataFrame:
    """Share of all revenue per tier. The window spans the tier rows, not sales lines."""
    everything = F.sum("_exact").over(Window.partitionBy())
    return (
        _LOYALTY.over(fact)
        .withColumn("revenue_pct", half_up(ratio(F.col("_exact") * 100, everything), 1))
        .drop("_exact")
        .orderBy(F.desc("revenue"), "loyalty_tier")
    )


def top_items(fact: DataFrame) -> DataFrame:
    return _TOP_ITEMS.over(fact)


def regional_performance(fact: DataFrame) -> DataFrame:
    return _REGION.over(fact).orderBy(F.desc("total_revenue"), "region")
