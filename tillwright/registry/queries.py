"""The queries: name -> function of (session, folder of the order tables)."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillwright.functions import bands, dates, money, text
from tillwright.functions.casting import parse_date, parse_flag, typed_columns
from tillwright.functions.measures import flagged, mean, total
from tillwright.operators import bitmaps, colocated
from tillwright.operators.audit import preview, row_counts
from tillwright.operators.dedup import distinct_values, latest_per_key
from tillwright.operators.joins import fits_broadcast, hot_keys, orphans
from tillwright.operators.ranking import rank_all
from tillwright.plans import alerts, gold, medallion, quality, silver, views
from tillwright.schemas import FILE_NAMES, SOURCES, silver_types
from tillwright.session import remove, tidy, work_dir
from tillwright.sources.calendar import calendar_between
from tillwright.sources.flat_files import read_flat_file, stamp, write_flat_file
from tillwright.sources.lake import Lake
from tillwright.sources.star import Star
from tillwright.streaming import revenue_alert

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-02"
BATCH_TS = datetime.datetime(2001, 8, 2, 2, 0, 0)
#: Segment bounds under which all four segments occur in the order tables.
SEGMENTS = bands.SegmentThresholds(
    champion_orders=45, champion_spend=2_500_000, loyal_orders=30, loyal_days=60, lapsed_days=180
)
DAILY_TARGET = 1_000_000.0
STREAM_TARGET = 3_000.0
COLOCATED_BUCKETS = 16

QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type the published columns have."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else f.name
        for f in df.schema
    ])


def query(make: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Registers a function of the star tables under its own name."""

    @wraps(make)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(make(Star(spark, folder)))

    QUERIES[make.__name__] = run
    return make


def _fact(star: Star, *keys: str) -> DataFrame:
    """The sales fact with the dimensions a query needs, and with any that repeats a key, since
    that multiplies lines."""
    tables = star.silver(AS_OF)
    names = {
        "customer_id": "customers", "item_id": "items", "store_id": "stores", "date_id": "calendar"
    }
    needed = [key for key in names if key in keys or key in star.repeated_keys]
    dimensions = {key: tables[names[key]] for key in needed}
    return gold.star_join(tables["txns"], dimensions, star.key_tables)


def _lake(star: Star, purpose: str) -> Lake:
    """A catalog schema of its own over a new folder of the shared work area."""
    root = work_dir(star.spark, purpose)
    lake = Lake(star.spark, database=root.rsplit("/", 1)[1].replace("-", "_"), root=root)
    lake.create()
    return lake


# ---- sources and sinks -------------------------------------------------------------------


@query
def src_csv_roundtrip(star: Star) -> DataFrame:
    path = f"{work_dir(star.spark, 'csv')}/{FILE_NAMES['transactions']}"
    write_flat_file(star.transactions, path)
    return read_flat_file(star.spark, path, SOURCES["transactions"])


@query
def bronze_stamp(star: Star) -> DataFrame:
    return stamp(star.customers, FILE_NAMES["customer_dim"], BATCH_TS).select(
        "customer_id", "_source_file", F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss")
        .alias("_ingested_at"), "_batch_date",
    )


@query
def bronze_load(star: Star) -> DataFrame:
    raw_dir = work_dir(star.spark, "raw")
    lake = _lake(star, "bronze")
    for table, df in star.raw().items():
        write_flat_file(df, f"{raw_dir}/{FILE_NAMES[table]}")
    medallion.load_all_bronze(lake, raw_dir, BATCH_TS)
    return medallion.layer_audit(lake, "bronze")


@query
def sink_overwrite(star: Star) -> DataFrame:
    """The second write replaces the first, schema included."""
    lake = _lake(star, "overwrite")
    lake.write(star.customers, "customers")
    lake.write(star.silver(AS_OF)["customers"], "customers")
    return lake.read("customers")


@query
def sink_append(star: Star) -> DataFrame:
    """Two loads on two days leave two partitions."""
    lake = _lake(star, "append")
    for day in (AS_OF, "2001-08-03"):
        batch = stamp(star.stores, FILE_NAMES["store_dim"], BATCH_TS, day)
        lake.write(batch, "stores", "append", partition_by=["_batch_date"])
    return lake.read("stores").select("_batch_date", "store_id", "store_name", "_source_file")


@query
def audit_counts(star: Star) -> DataFrame:
    return row_counts(star.silver(AS_OF))


@query
def preview_top_categories(star: Star) -> DataFrame:
    return gold.top_categories(gold.gold_sales_by_category(_fact(star, "item_id")))


@query
def preview_transactions(star: Star) -> DataFrame:
    order = ["transaction_id", "item_id", "store_id", "total_amount"]
    return preview(star.transactions, order, columns=[*order, "quantity", "channel"])


@query
def dim_calendar(star: Star) -> DataFrame:
    return star.calendar


@query
def dim_calendar_between(star: Star) -> DataFrame:
    """A calendar of given days, joined with the order days that fall into it."""
    calendar = calendar_between(star.spark, "1996-01-01", "1997-12-31")
    placed = star.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return calendar.join(placed, "full_date", "left").select(
        "date_id", "full_date", "fiscal_quarter", "is_holiday", "orders"
    )


@query
def txn_pricing(star: Star) -> DataFrame:
    """All line amounts at the standard tax rate."""
    amounts = money.price_line(F.col("unit_price"), F.col("quantity"), F.col("discount_pct"))
    return star.order_lines.select(
        F.col("l_orderkey").alias("transaction_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_linenumber").alias("line"), "quantity", "unit_price", "discount_pct",
        *[column.alias(name) for name, column in amounts.items()],
    )


# ---- projections and scalar functions ----------------------------------------------------


@query
def silver_casts(star: Star) -> DataFrame:
    """All transaction columns typed from text."""
    raw = star.transactions.select(*[F.col(c).cast("string") for c in star.transactions.columns])
    return raw.withColumns(typed_columns(raw, silver_types("transactions")))


@query
def fn_string_clean(star: Star) -> DataFrame:
    return star.customers.select(
        "customer_id",
        text.proper_case(F.col("full_name")).alias("full_name"),
        text.clean_lower(F.col("email")).alias("email"),
        text.clean_upper(F.col("country")).alias("country"),
    )


@query
def fn_dates(star: Star) -> DataFrame:
    written = F.date_format("o_orderdate", "yyyy-MM-dd")
    return (
        star.table("orders")
        .select("o_orderkey", parse_date(written).alias("order_date"))
        .withColumns({
            "date_id": dates.date_key(F.col("order_date")),
            "days_ago": dates.days_between(dates.as_of_date(AS_OF), F.col("order_date")),
            "iso_weekday": dates.iso_weekday(F.col("order_date")),
        })
    )


@query
def fn_margin(star: Star) -> DataFrame:
    return star.items.select(
        "item_id",
        "unit_price",
        "cost_price",
        money.margin_percent(F.col("unit_price"), F.col("cost_price")).alias("margin_pct"),
    )


@query
def fn_age_band(star: Star) -> DataFrame:
    return star.customers.select("customer_id", "age", bands.age_band(F.col("age")).alias("age_band"))


@query
def fn_price_band(star: Star) -> DataFrame:
    price = F.col("unit_price")
    return star.items.select("item_id", "unit_price", bands.price_band(price).alias("price_band"))


@query
def fn_rfm_segment(star: Star) -> DataFrame:
    """Segments from orders alone, counting orders and their value."""
    per_customer = star.table("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"),
        dates.days_between(
            dates.as_of_date(AS_OF), F.max(F.col("o_orderdate").cast("date"))
        ).alias("recency_days"),
    )
    bounds = bands.SegmentThresholds(
        champion_orders=12, champion_spend=3_000_000, loyal_orders=8, loyal_days=60, lapsed_days=180
    )
    return per_customer.withColumn(
        "rfm_segment",
        bands.customer_segment(F.col("orders"), F.col("spend"), F.col("recency_days"), bounds),
    )


@query
def fn_boolean_flags(star: Star) -> DataFrame:
    active = parse_flag(F.col("is_active"))
    return star.customers.select(
        "customer_id", active.alias("is_active"), active.cast("int").alias("active_int")
    )


@query
def fn_profit(star: Star) -> DataFrame:
    profit = money.line_profit(F.col("net_amount"), F.col("quantity"), F.col("unit_price"), "0.6")
    return star.transactions.select(
        "transaction_id", "item_id", "net_amount", profit.alias("profit_amount")
    )


@query
def fn_tenure_years(star: Star) -> DataFrame:
    years = dates.years_since(F.col("join_date"), dates.as_of_date(AS_OF))
    return star.customers.select("customer_id", "join_date", years.alias("tenure_years"))


@query
def fn_name_email(star: Star) -> DataFrame:
    first, last = F.col("first_name"), F.col("last_name")
    return star.customers.select(
        "customer_id",
        text.full_name(first, last).alias("full_name"),
        text.email_address(first, last, F.col("customer_id")).alias("email"),
    )


# ---- joins -------------------------------------------------------------------------------


@query
def join_left_customer(star: Star) -> DataFrame:
    return _fact(star, "customer_id").select(
        "transaction_id", *gold.CUSTOMER_KEYS, "total_amount"
    )


@query
def join_left_item(star: Star) -> DataFrame:
    return _fact(star, "item_id").select(
        "transaction_id", "item_id", *gold.ATTRIBUTES["item_id"], "total_amount"
    )


@query
def join_left_store(star: Star) -> DataFrame:
    return _fact(star, "store_id").select(
        "transaction_id", "store_id", *gold.ATTRIBUTES["store_id"], "total_amount"
    )


@query
def join_left_calendar(star: Star) -> DataFrame:
    return _fact(star, "date_id").select(
        "transaction_id", "date_id", *gold.ATTRIBUTES["date_id"], "total_amount"
    )


@query
def join_anti_orphans(star: Star) -> DataFrame:
    """Sales of customers that are not active."""
    active = star.customers.where(F.col("is_active") == "Y")
    hot = {} if fits_broadcast(active) else hot_keys(star.key_tables["customer_id"], ["customer_id"])
    lost = orphans(star.transactions, active, "customer_id", hot.get("customer_id", {}))
    return lost.select(
        "transaction_id", "customer_id", "item_id", "total_amount"
    )


# ---- aggregates and windows --------------------------------------------------------------


@query
def agg_global(star: Star) -> DataFrame:
    return star.silver(AS_OF)["txns"].agg(
        F.count(F.lit(1)).alias("lines"),
        total("total_amount").alias("total_revenue"),
        mean("total_amount").alias("avg_order_value"),
        F.sum("quantity").alias("units"),
    )


@query
def agg_grouped(star: Star) -> DataFrame:
    return (
        star.silver(AS_OF)["txns"]
        .groupBy("payment_method", "channel", "transaction_status")
        .agg(
            F.count("transaction_id").alias("lines"),
            total("total_amount").alias("total_revenue"),
            total("profit_amount").alias("total_profit"),
            mean("discount_pct").alias("avg_discount_pct"),
        )
    )


@query
def agg_count_distinct(star: Star) -> DataFrame:
    return star.transactions.groupBy("channel").agg(
        F.count_distinct("transaction_id").alias("transactions"),
        F.count_distinct("customer_id").alias("customers"),
    )


@query
def agg_conditional_count(star: Star) -> DataFrame:
    return star.silver(AS_OF)["txns"].groupBy("store_id").agg(
        flagged("return_flag").alias("returns"), F.count(F.lit(1)).alias("lines")
    )


@query
def agg_min_max_date(star: Star) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return star.table("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(day).alias("first_purchase_date"), F.max(day).alias("last_purchase_date")
    )


@query
def agg_safe_ratio(star: Star) -> DataFrame:
    """Discount per tax of each item: null where an item's lines carry no tax."""
    sums = star.transactions.groupBy("item_id", "channel").agg(
        F.sum("discount_amount").alias("discount"), F.sum("tax_amount").alias("tax")
    )
    return sums.withColumn("discount_per_tax_pct", money.percent(F.col("discount"), F.col("tax")))


@query
def distinct_keys(star: Star) -> DataFrame:
    return distinct_values(star.transactions, "customer_id")


@query
def dedup_latest(star: Star) -> DataFrame:
    """The last line of each transaction by day, then amount."""
    lines = star.transactions.select(
        "transaction_id", "date_id", "total_amount", "item_id", "store_id", "quantity"
    )
    return latest_per_key(lines, ["transaction_id"], ["date_id", "total_amount"])


@query
def win_rank_category(star: Star) -> DataFrame:
    return gold.gold_sales_by_category(_fact(star, "item_id")).select(
        *gold.CATEGORY_KEYS, "total_revenue", "revenue_rank"
    )


@query
def win_rank_items(star: Star) -> DataFrame:
    """All items by their revenue, ranked by ranges instead of in one task."""
    revenue = star.transactions.groupBy("item_id").agg(total("total_amount").alias("total_revenue"))
    path = work_dir(star.spark, "item-revenue")
    revenue.write.parquet(path)
    return rank_all(star.spark.read.schema(revenue.schema).parquet(path), "total_revenue", "revenue_rank")


# ---- silver and gold tables --------------------------------------------------------------


@query
def silver_customer(star: Star) -> DataFrame:
    return star.silver(AS_OF)["customers"]


@query
def silver_item(star: Star) -> DataFrame:
    return star.silver(AS_OF)["items"]


@query
def silver_store(star: Star) -> DataFrame:
    return star.silver(AS_OF)["stores"]


@query
def silver_calendar(star: Star) -> DataFrame:
    return star.silver(AS_OF)["calendar"]


@query
def silver_transactions(star: Star) -> DataFrame:
    return star.silver(AS_OF)["txns"]


@query
def gold_fact_sales(star: Star) -> DataFrame:
    return _fact(star, "customer_id", "item_id", "store_id", "date_id")


@query
def gold_sales_daily(star: Star) -> DataFrame:
    return gold.gold_sales_daily(_fact(star, "date_id"))


@query
def gold_sales_by_category(star: Star) -> DataFrame:
    return gold.gold_sales_by_category(_fact(star, "item_id"))


@query
def gold_customer_summary(star: Star) -> DataFrame:
    """Customers are joined to the sums; a repeated customer key would need them joined to the lines."""
    if "customer_id" in star.repeated_keys:
        fact = _fact(star, "customer_id", "item_id", "date_id")
        return gold.gold_customer_summary(fact, AS_OF, SEGMENTS)
    customers = star.silver(AS_OF)["customers"]
    return gold.gold_customer_summary_of(_fact(star, "item_id", "date_id"), customers, AS_OF, SEGMENTS)


# ---- views and analytics queries ---------------------------------------------------------


@query
def v1_executive_kpis(star: Star) -> DataFrame:
    return views.VIEWS["vw_executive_kpis"].over(_fact(star))


@query
def v2_revenue_by_category(star: Star) -> DataFrame:
    return views.VIEWS["vw_revenue_by_category"].over(_fact(star, "item_id"))


@query
def v3_monthly_trend(star: Star) -> DataFrame:
    return views.VIEWS["vw_monthly_trend"].over(_fact(star, "date_id"))


@query
def v4_top_customers(star: Star) -> DataFrame:
    """Customers are joined to the fifty that are left."""
    if "customer_id" in star.repeated_keys:
        return views.VIEWS["vw_top_customers"].over(_fact(star, "customer_id", "date_id"))
    return views.top_customers_of(_fact(star, "date_id"), star.silver(AS_OF)["customers"])


@query
def v5_store_performance(star: Star) -> DataFrame:
    return views.VIEWS["vw_store_performance"].over(_fact(star, "store_id"))


@query
def q1_kpi_summary(star: Star) -> DataFrame:
    return views.kpi_summary(v1_executive_kpis(star))


@query
def q2_top_categories(star: Star) -> DataFrame:
    return views.best_categories(v2_revenue_by_category(star))


@query
def q3_mom_growth(star: Star) -> DataFrame:
    return views.monthly_growth(v3_monthly_trend(star))


@query
def q4_channel(star: Star) -> DataFrame:
    return views.revenue_by_channel(_fact(star))


@query
def q5_weekend(star: Star) -> DataFrame:
    return views.weekend_split(_fact(star, "date_id"))


@query
def q6_loyalty_breakdown(star: Star) -> DataFrame:
    return views.loyalty_breakdown(_fact(star, "customer_id"))


@query
def q7_top_items(star: Star) -> DataFrame:
    return views.top_items(_fact(star, "item_id"))


@query
def q8_region(star: Star) -> DataFrame:
    return views.regional_performance(_fact(star, "store_id"))


def _catalog(star: Star) -> Lake:
    """The fact joined with all dimensions, written once per session and folder, under its views."""
    known = (star.spark.sparkContext.applicationId, star.folder)
    if known not in _catalogs or not star.spark.catalog.databaseExists(_catalogs[known].database):
        tables = star.silver(AS_OF)
        dimensions = {key: tables[name] for key, name in gold.DIMENSION_OF.items()}
        lake = _lake(star, "views")
        with tidy(star.spark):
            if gold.large_keys(dimensions):
                # The joins go over the lines in parts, so the order and its lines are joined once before.
                lake.write(tables["txns"].select(*gold.KEYS, *gold.MEASURES, *gold.LABELS), "lines", dense=True)
                lines = lake.read("lines")
            else:
                lines = tables["txns"]
            lake.write(gold.star_join_parts(lines, dimensions, star.key_tables), views.FACT, dense=True)
        star.spark.sql(f"DROP TABLE IF EXISTS {lake.name('lines')}")
        remove(star.spark, f"{lake.root}/lines")
        views.create_catalog_views(star.spark, lake.database)
        _catalogs[known] = lake
    return _catalogs[known]


_catalogs: dict[tuple[str, str], Lake] = {}


@query
def catalog_executive_kpis(star: Star) -> DataFrame:
    return _catalog(star).read("vw_executive_kpis")


@query
def catalog_revenue_by_category(star: Star) -> DataFrame:
    return _catalog(star).read("vw_revenue_by_category")


@query
def catalog_monthly_trend(star: Star) -> DataFrame:
    return _catalog(star).read("vw_monthly_trend")


@query
def catalog_top_customers(star: Star) -> DataFrame:
    return _catalog(star).read("vw_top_customers")


@query
def catalog_store_performance(star: Star) -> DataFrame:
    return _catalog(star).read("vw_store_performance")


# ---- order of rows, orphans, planted violations ---------------------------------------------


def _numbered(df: DataFrame, *columns: str) -> DataFrame:
    """The rows as they come, with their place; `df` is sorted, so its partitions are in order."""
    placed = df.select(*columns).withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


@query
def order_sales_daily(star: Star) -> DataFrame:
    return _numbered(gold.gold_sales_daily(_fact(star, "date_id")), "full_date")


@query
def order_mom_growth(star: Star) -> DataFrame:
    return _numbered(q3_mom_growth(star), "year", "month")


@query
def order_channel(star: Star) -> DataFrame:
    return _numbered(q4_channel(star), "channel")


@query
def order_region(star: Star) -> DataFrame:
    return _numbered(q8_region(star), "region")


def _with_orphans(star: Star) -> DataFrame:
    """Sales lines of which some name no customer, or a customer, item, store or day that is not there."""
    number = F.col("transaction_id")
    lost = {"customer_id": 0, "item_id": 1, "store_id": 2, "date_id": 3}
    return star.silver(AS_OF)["txns"].withColumns({
        key: F.when(number % 7 == rest, None if key == "customer_id" else -1).otherwise(F.col(key))
        for key, rest in lost.items()
    })


@query
def join_left_orphans(star: Star) -> DataFrame:
    """Every line stays, with nulls where a dimension has no row for it."""
    tables = star.silver(AS_OF)
    fact = gold.gold_fact_sales(
        _with_orphans(star), tables["customers"], tables["items"], tables["stores"],
        tables["calendar"], star.key_tables,
    )
    return fact.groupBy(
        F.col("full_name").isNull().alias("no_customer"), F.col("item_name").isNull().alias("no_item"),
        F.col("store_name").isNull().alias("no_store"), F.col("day_name").isNull().alias("no_day"),
    ).agg(F.count(F.lit(1)).alias("lines"), total("total_amount").alias("revenue"))


@query
def dq_planted(star: Star) -> DataFrame:
    """Standard rules over rows that break each of them."""
    tables = dict(star.silver(AS_OF))
    key = F.col("customer_id")
    tables["customers"] = tables["customers"].withColumns({
        "email": F.when(key % 5 != 0, F.col("email")), "age": F.when(key % 9 == 0, 17).otherwise(F.col("age")),
    })
    tables["items"] = tables["items"].withColumns({
        "category": F.when(F.col("item_id") % 4 != 0, F.col("category")),
        "unit_price": F.when(F.col("item_id") % 6 == 0, 0).otherwise(F.col("unit_price")),
    })
    tables["txns"] = _with_orphans(star).withColumns({
        "quantity": F.when(F.col("transaction_id") % 11 == 0, 0).otherwise(F.col("quantity")),
        "discount_pct": F.when(F.col("transaction_id") % 13 == 0, 2).otherwise(F.col("discount_pct")),
    })
    return quality.report(tables)


@query
def silver_bad_text(star: Star) -> DataFrame:
    """Text that does not parse becomes null, and provenance columns go."""
    bad = star.stores.select(*[F.col(c).cast("string") for c in star.stores.columns]).withColumns({
        "sq_footage": F.when(F.col("store_id") % 2 == 0, "n/a").otherwise(F.col("sq_footage")),
        "open_date": F.when(F.col("store_id") % 3 == 0, "soon").otherwise(F.col("open_date")),
        "is_active": F.when(F.col("store_id") % 5 == 0, "?").otherwise(F.col("is_active")),
    })
    refined = silver.silver_store(stamp(bad, FILE_NAMES["store_dim"], BATCH_TS), AS_OF)
    return refined.select("store_id", "sq_footage", "open_date", "is_active", F.lit(len(refined.columns)).alias("width"))


@query
def dedup_null_keys(star: Star) -> DataFrame:
    """Rows without a key all stay."""
    lines = star.transactions.select(
        F.when(F.col("transaction_id") % 4 != 0, F.col("transaction_id")).alias("transaction_id"),
        "date_id", "total_amount", "item_id", "store_id", "quantity",
    )
    return latest_per_key(lines, ["transaction_id"], ["date_id", "total_amount"])


@query
def fn_profit_four_digits(star: Star) -> DataFrame:
    profit = money.line_profit(F.col("net_amount"), F.col("quantity"), F.col("unit_price"), "0.5531")
    return star.transactions.select(
        "transaction_id", "item_id", "net_amount", profit.alias("profit_amount")
    )


# ---- data quality ------------------------------------------------------------------------


def _stored(star: Star) -> dict[str, DataFrame]:
    """Silver tables, the sales lines written once with the columns that rules look at.

    The checks go over the lines several times; that way their join is worked out once.
    """
    tables = dict(star.silver(AS_OF))
    columns = [*gold.KEYS, "total_amount", "quantity", "discount_pct"]
    path = work_dir(star.spark, "checked-lines")
    lines = tables["txns"].select(*columns)
    lines.write.parquet(path)
    return {**tables, "txns": star.spark.read.schema(lines.schema).parquet(path)}


def _report(star: Star, keep: Callable[[quality.Rule], bool] = lambda rule: True) -> DataFrame:
    rules = [r for r in quality.STANDARD_RULES if keep(r)]
    over_lines = [r for r in rules if r.table == "txns"]
    tables = _stored(star) if len(over_lines) > 1 else star.silver(AS_OF)
    return quality.report(tables, rules)


def _checks(*endings: str) -> Callable[[quality.Rule], bool]:
    return lambda rule: rule.check.endswith(endings)


@query
def dq_not_null(star: Star) -> DataFrame:
    return _report(star, _checks("not null"))


@query
def dq_range(star: Star) -> DataFrame:
    return _report(star, lambda rule: " between " in rule.check)


@query
def dq_positive(star: Star) -> DataFrame:
    return _report(star, _checks("> 0"))


@query
def dq_column_compare(star: Star) -> DataFrame:
    return _report(star, _checks("< unit_price"))


@query
def dq_domain(star: Star) -> DataFrame:
    return _report(star, _checks("valid values"))


@query
def dq_unique(star: Star) -> DataFrame:
    return _report(star, _checks("unique"))


@query
def dq_ref_integrity(star: Star) -> DataFrame:
    """The three standard references, and one against active customers that must fail."""
    tables = _stored(star)
    tables["active"] = tables["customers"].where("is_active")
    rules = [r for r in quality.STANDARD_RULES if isinstance(r, quality.ReferenceRule)]
    rules.append(quality.ReferenceRule("customer_id active", "txns", "customer_id", "active"))
    return quality.report(tables, rules)


@query
def dq_more_rules(star: Star) -> DataFrame:
    """Rules beyond the standard ones, a line each."""
    return quality.report(star.silver(AS_OF), [
        quality.unique("stores", "store_id"),
        quality.unique("calendar", "date_id"),
        quality.within("calendar", "month", 1, 12),
        quality.refers("txns", "date_id", "calendar"),
    ])


@query
def dq_report(star: Star) -> DataFrame:
    return _report(star)


@query
def dq_summary(star: Star) -> DataFrame:
    return quality.summary(_report(star))


@query
def dq_failures(star: Star) -> DataFrame:
    return quality.failures(_report(star))


@query
def dq_gate(star: Star) -> DataFrame:
    return quality.verdict(_report(star))


# ---- the whole job and the alerts --------------------------------------------------------


def _deliver(tables: dict[str, DataFrame], raw_dir: str) -> None:
    """Writes the source files of a batch."""
    for table, df in tables.items():
        with tidy(df.sparkSession):
            write_flat_file(df, f"{raw_dir}/{FILE_NAMES[table]}", "gzip")


@query
def medallion_e2e(star: Star) -> DataFrame:
    """Flat files to gold. The gate only warns: these tables break three rules on purpose."""
    raw_dir = work_dir(star.spark, "raw")
    _deliver(star.raw(), raw_dir)
    lake = _lake(star, "medallion")
    medallion.run_medallion(
        lake, raw_dir, as_of=AS_OF, gate=False, batch_ts=BATCH_TS, thresholds=SEGMENTS, clear_raw=True
    )
    return medallion.reconciliation(lake)


def _append_batches(star: Star, purpose: str, first_lines: DataFrame, second_lines: DataFrame) -> DataFrame:
    """Row counts after two daily batches of lines and a second run of the later one."""
    lake = _lake(star, purpose)
    raw_dir = work_dir(star.spark, f"{purpose}-files")
    first = {**star.raw(), "transactions": first_lines}
    changed = star.stores.withColumn("manager_name", F.lit("New manager")).where(F.col("store_id") % 2 == 0)
    second = {**star.raw(), "transactions": second_lines, "store_dim": changed}
    days = (BATCH_TS, BATCH_TS + datetime.timedelta(days=1))
    for number, (batch, day) in enumerate(zip((first, second, second), (*days, days[1]), strict=True)):
        _deliver(batch, f"{raw_dir}/{number}")
        medallion.run_medallion(
            lake, f"{raw_dir}/{number}", as_of=AS_OF, gate=False, batch_ts=day, append=True, dedup=True,
            catalog_views=False, clear_raw=True,
        )
    bronze = lake.read("bronze_transactions").groupBy("_batch_date").count()
    new = lake.read("silver_store_dim").where("manager_name = 'New manager'")
    return (
        bronze.select(F.concat(F.lit("bronze "), F.col("_batch_date").cast("string")).alias("part"),
                      F.col("count").alias("row_count"))
        .unionByName(medallion.layer_audit(lake, "silver").select(F.col("table_name").alias("part"), "row_count"))
        .unionByName(new.agg(F.lit("new managers").alias("part"), F.count(F.lit(1)).alias("row_count")))
    )


@query
def medallion_append_all(star: Star) -> DataFrame:
    """All lines of all orders in two daily batches, even orders before odd ones, and the later one again;
    silver keeps one row of each key."""
    even = F.col("transaction_id") % 2 == 0
    lines = star.transactions
    return _append_batches(star, "all-batches", lines.where(even), lines.where(~even))


def _refreshed(star: Star, purpose: str) -> Lake:
    """Two daily batches of all lines. The second brings the odd orders, some lines of every fifth even order
    again, and a seventh of the customers with another tier; only what it touches is made again."""
    lake = _lake(star, purpose)
    raw_dir = work_dir(star.spark, f"{purpose}-files")
    lines, customers = star.transactions, star.customers
    odd = F.col("transaction_id") % 2 != 0
    again = (F.col("transaction_id") % 10 == 0) & (F.col("quantity") <= 25)
    promoted = customers.where(F.col("customer_id") % 7 == 0).withColumn("loyalty_tier", F.lit("Gold"))
    batches = (
        {**star.raw(), "transactions": lines.where(~odd)},
        {**star.raw(), "transactions": lines.where(odd | again), "customer_dim": promoted},
    )
    for number, batch in enumerate(batches):
        _deliver(batch, f"{raw_dir}/{number}")
        medallion.run_medallion(
            lake, f"{raw_dir}/{number}", as_of=AS_OF, gate=False, batch_ts=BATCH_TS + datetime.timedelta(days=number),
            append=True, catalog_views=False, thresholds=SEGMENTS, clear_raw=True,
        )
    return lake


@query
def medallion_refresh(star: Star) -> DataFrame:
    """The customer table after two daily batches, merged from stored states."""
    return _refreshed(star, "refresh").read("gold_customer_summary")


@query
def medallion_refresh_daily(star: Star) -> DataFrame:
    """The daily table after two daily batches, its customers counted by bitmaps."""
    return _refreshed(star, "refresh-daily").read("gold_sales_daily")


@query
def medallion_refresh_tables(star: Star) -> DataFrame:
    """Rows and revenue of the gold tables after two daily batches: the same revenue in all four."""
    return medallion.reconciliation(_refreshed(star, "refresh-tables"))


@query
def medallion_columns(star: Star) -> DataFrame:
    """The customer table of a whole job, all columns."""
    raw_dir = work_dir(star.spark, "column-files")
    _deliver(star.raw(), raw_dir)
    lake = _lake(star, "columns")
    medallion.run_medallion(
        lake, raw_dir, as_of=AS_OF, gate=False, batch_ts=BATCH_TS, thresholds=SEGMENTS,
        catalog_views=False, clear_raw=True,
    )
    return lake.read("gold_customer_summary")


@query
def alert_daily_revenue(star: Star) -> DataFrame:
    daily = gold.gold_sales_daily(_fact(star, "date_id"))
    return alerts.days_below(daily, DAILY_TARGET)


@query
def alert_daily_revenue_stream(star: Star) -> DataFrame:
    """The alert over the purchase events, run until all files present are read."""
    spark, schema = star.spark, star.table("events").schema
    # The pattern lets the table be one file or a folder of files.
    session = revenue_alert.stream_session(spark, partitions=8)
    events = revenue_alert.event_stream(session, f"{star.folder}/events.parquet*", schema)
    out, checkpoint = work_dir(spark, "alerts"), work_dir(spark, "alerts-checkpoint")
    revenue_alert.start_alert(events, STREAM_TARGET, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


@query
def alert_repeated_events(star: Star) -> DataFrame:
    """The alert over purchase events that were delivered twice: the same days as over single files."""
    spark, schema = star.spark, star.table("events").schema
    folder = work_dir(spark, "events-twice")
    for _ in range(2):
        star.table("events").write.mode("append").parquet(folder)
    session = revenue_alert.stream_session(spark, partitions=8)
    events = revenue_alert.event_stream(session, folder, schema)
    out, checkpoint = work_dir(spark, "alerts-once"), work_dir(spark, "alerts-once-checkpoint")
    revenue_alert.start_alert(events, STREAM_TARGET, out, checkpoint, once_by="event_id").awaitTermination()
    return spark.read.parquet(out)


@query
def quarantine_lines(star: Star) -> DataFrame:
    """Customers with planted bad fields: good lines in bronze, bad ones apart by reason, all counted."""
    lake, raw_dir = _lake(star, "quarantine"), work_dir(star.spark, "bad-lines")
    key = F.col("customer_id")
    bad = star.customers.withColumns({
        "age": F.when(key % 50 == 0, "old").otherwise(F.col("age").cast("string")),
        "join_date": F.when(key % 75 == 0, "someday").otherwise(F.col("join_date").cast("string")),
    })
    write_flat_file(bad, f"{raw_dir}/{FILE_NAMES['customer_dim']}")
    medallion.load_bronze(lake, raw_dir, "customer_dim", BATCH_TS, quarantine=True)
    good, kept = lake.read("bronze_customer_dim"), lake.read("quarantine_customer_dim")
    number = F.split_part("line", F.lit(","), F.lit(1)).cast("long")
    return good.agg(F.lit("readable").alias("part"), F.count(F.lit(1)).alias("lines"), F.sum(key).alias("ids")).unionByName(
        kept.groupBy(F.col("reason").alias("part")).agg(F.count(F.lit(1)).alias("lines"), F.sum(number).alias("ids"))
    ).unionByName(
        quality.readable_lines("customers", good, kept).select(
            F.concat_ws(" ", "check", "status").alias("part"), F.col("total").alias("lines"), F.col("failing").alias("ids")
        )
    )


@query
def sink_publish(star: Star) -> DataFrame:
    """A published table after a second version with the same columns took its place."""
    lake = _lake(star, "published")
    lake.publish(star.customers, "customers")
    lake.publish(star.customers.withColumn("city", F.upper("city")), "customers")
    return lake.read("customers")


@query
def agg_distinct_bitmaps(star: Star) -> DataFrame:
    """Different customers and items per month, by bitmaps: one narrow aggregate each, no row multiplied."""
    lines = star.transactions.select(F.expr("date_id div 100").cast("int").alias("month"), "customer_id", "item_id")
    path = work_dir(star.spark, "month-lines")
    lines.write.parquet(path)
    stored = star.spark.read.schema(lines.schema).parquet(path)
    customers, items = (
        bitmaps.distinct_count(bitmaps.key_sets(stored, key, "month"), "month") for key in ("customer_id", "item_id")
    )
    return customers.withColumnRenamed("n", "customers").join(items.withColumnRenamed("n", "items"), "month")


@query
def join_colocated_customer(star: Star) -> DataFrame:
    """Lines and customers stored in the same buckets and joined without an exchange, in two loads.

    A third of the orders name one customer, some none at all, and some one that is not there.
    """
    lake, number = _lake(star, "colocated"), F.col("transaction_id")
    lines = star.silver(AS_OF)["txns"].select("transaction_id", "date_id", "item_id", "total_amount", F.when(
        number % 3 == 0, 1).when(number % 7 != 0, F.col("customer_id")).when(number % 2 == 0, -1).alias("customer_id"))
    lake.write(lines, "lines")
    stored, even = lake.read("lines"), number % 2 == 0
    layout = colocated.plan_layout(stored, "customer_id", COLOCATED_BUCKETS)
    colocated.store_lines(lake, stored.where(even), "lines_beside", layout)
    colocated.append_lines(lake, stored.where(~even), "lines_beside")
    customers = star.silver(AS_OF)["customers"].select(*gold.CUSTOMER_KEYS)
    colocated.store_lookup(lake, customers, "customers_beside", "lines_beside")
    return colocated.join_stored(lake, "lines_beside", "customers_beside").select(
        "transaction_id", "date_id", "item_id", *gold.CUSTOMER_KEYS, "total_amount"
    )


@query
def medallion_colocated(star: Star) -> DataFrame:
    """Revenue by country and year of joining, columns that the fact does not hold, over a co-located fact."""
    raw_dir, lake = work_dir(star.spark, "beside-files"), _lake(star, "beside")
    _deliver(star.raw(), raw_dir)
    medallion.run_medallion(
        lake, raw_dir, as_of=AS_OF, gate=False, batch_ts=BATCH_TS, thresholds=SEGMENTS,
        catalog_views=False, colocate=COLOCATED_BUCKETS, clear_raw=True,
    )
    return medallion.fact_with_customers(lake).groupBy(
        "country", F.year("join_date").alias("joined"), "loyalty_tier"
    ).agg(F.count(F.lit(1)).alias("lines"), total("total_amount").alias("revenue"))
