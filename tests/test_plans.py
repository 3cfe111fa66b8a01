"""Silver, gold, views and quality on small tables with nulls, ties and orphans."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwright.functions.bands import SegmentThresholds
from tillwright.operators import joins
from tillwright.plans import alerts, gold, quality, silver, views
from tillwright.schemas import CUSTOMER, ITEM, STORE, TRANSACTION, silver_types
from tillwright.sources.calendar import calendar_between, calendar_over
from tillwright.sources.flat_files import PROVENANCE, stamp

D = Decimal
AS_OF = "2023-12-31"


@pytest.fixture
def tables(spark):
    day = datetime.date(2020, 2, 29)
    customers = spark.createDataFrame([
        (1, "Ann", "Lee", " ann lee ", " ANN@X.COM", "1", "Dallas", "TX", " usa", 24, "Female",
         "Gold", day, "Y"),
        (2, "Bo", "Kim", "bo kim", "bo@x.com", "2", "Austin", "TX", "usa", None, "Male",
         "Copper", None, "?"),
    ], CUSTOMER)
    items = spark.createDataFrame([
        (10, "Pen", "Office", "Small", "B", D("10.00"), D("4.57"), 0.1, "Y", day, 1),
        (11, "Desk", "Office", "Large", "B", D("0.00"), D("4.00"), 9.0, "N", day, 1),
    ], ITEM)
    stores = spark.createDataFrame([
        (100, "Main", "Flagship", "Dallas", "TX", "USA", "South", 900, day, "M", "3", "Y"),
    ], STORE)

    def sale(number, customer, item, store, date_id, quantity, price, total, flag, channel):
        money = D(total)
        return (number, customer, item, store, date_id, quantity, D(price), D("0.10"), D("1.00"),
                money, money, D("0.00"), money, "Cash", channel, flag, "Completed")

    sales = spark.createDataFrame([
        sale(1, 1, 10, 100, 20231231, 2, "10", "20.00", "N", "Online"),
        sale(1, 1, 10, 100, 20231230, 1, "10", "10.00", "Y", "Online"),
        sale(2, 2, 11, 100, 20231230, 1, "30", "30.00", "N", "Store"),
        sale(3, 9, 99, 999, 19990101, 1, "5", "5.00", None, "Store"),
        sale(4, None, 10, 100, 20231101, 1, "10", "0.00", "N", None),
    ], TRANSACTION)
    calendar = silver.silver_calendar(calendar_between(spark, "2023-11-01", "2023-12-31"))
    return {
        "customers": silver.silver_customer(customers, AS_OF),
        "items": silver.silver_item(items),
        "stores": silver.silver_store(stores, AS_OF),
        "calendar": calendar,
        "txns": silver.silver_transactions(sales),
    }


@pytest.fixture
def fact(tables):
    return gold.gold_fact_sales(
        tables["txns"], tables["customers"], tables["items"], tables["stores"], tables["calendar"],
    )


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_silver_customer(tables):
    ann, bo = (r.asDict() for r in tables["customers"].orderBy("customer_id").collect())
    assert (ann["full_name"], ann["email"], ann["country"]) == ("Ann Lee", "ann@x.com", "USA")
    assert (ann["age_band"], ann["tenure_years"], ann["is_active"]) == ("18-24", 3.8, True)
    assert (bo["age_band"], bo["tenure_years"], bo["is_active"]) == ("55+", None, None)


def test_silver_drops_provenance_and_types_text(spark, tables):
    text = spark.createDataFrame([("5", "9", "1")], "store_id string, sq_footage string, x string")
    full = stamp(text, "store_dim.csv").select(
        "*", *[F.lit(None).cast("string").alias(f.name) for f in STORE if f.name not in text.columns]
    )
    refined = silver.silver_store(full, AS_OF)
    assert not set(PROVENANCE) & set(refined.columns)
    wanted = silver_types("store_dim")
    assert all(refined.schema[c].dataType == t for c, t in wanted.items())
    assert "x" in refined.columns


def test_silver_item_of_price_zero(tables):
    pen, desk = (r.asDict() for r in tables["items"].orderBy("item_id").collect())
    assert (pen["margin_pct"], pen["price_band"], pen["is_available"]) == (54.3, "Budget", True)
    assert (desk["margin_pct"], desk["price_band"], desk["is_available"]) == (None, "Budget", False)


def test_silver_cost_factor(tables):
    assert tables["txns"].where("transaction_id = 2").first()["profit_amount"] == D("13.50")


def test_fact_keeps_every_line(fact):
    assert len(fact.columns) == 39
    assert fact.count() == 5
    orphan = fact.where("transaction_id = 3").first()
    assert [orphan[c] for c in ("full_name", "item_name", "store_name", "full_date")] == [None] * 4


def test_fact_multiplies_on_duplicate_dimension_keys(tables):
    twice = tables["stores"].unionByName(tables["stores"])
    assert gold.star_join(tables["txns"], {"store_id": twice}).count() == 9


def test_daily(fact):
    rows = by(gold.gold_sales_daily(fact), "full_date")
    day = rows[(datetime.date(2023, 12, 30),)]
    assert (day["transaction_count"], day["total_revenue"], day["unique_customers"]) == (2, 40.0, 2)
    assert (day["return_count"], day["return_rate_pct"], day["avg_order_value"]) == (1, 50.0, 20.0)
    assert rows[(None,)]["return_count"] is None
    assert rows[(datetime.date(2023, 11, 1),)]["profit_margin_pct"] is None
    assert rows[(datetime.date(2023, 11, 1),)]["unique_customers"] == 0


def test_category_rank_shares_ties(tables, fact):
    tied = fact.withColumn(
        "total_amount", F.when(F.col("transaction_id") == 3, D("30.00")).otherwise(F.col("total_amount"))
    )
    rows = by(gold.gold_sales_by_category(tied), "category", "sub_category")
    ranks = {k: r["revenue_rank"] for k, r in rows.items()}
    assert ranks == {("Office", "Small"): 1, ("Office", "Large"): 1, (None, None): 1}
    lower = by(gold.gold_sales_by_category(fact), "category", "sub_category")
    assert lower[(None, None)]["revenue_rank"] == 3
    assert gold.top_categories(gold.gold_sales_by_category(fact), 1).count() == 1


def test_customer_summary(fact):
    at = SegmentThresholds(champion_orders=2, champion_spend=30)
    rows = by(gold.gold_customer_summary(fact, AS_OF, at), "customer_id")
    assert rows[(1,)]["rfm_segment"] == "Champion"
    assert (rows[(1,)]["days_since_purchase"], rows[(1,)]["customer_tenure_days"]) == (0, 1)
    assert (rows[(1,)]["total_orders"], rows[(1,)]["total_returns"]) == (2, 1)
    assert rows[(9,)]["rfm_segment"] == "Regular"
    assert rows[(9,)]["days_since_purchase"] is None
    assert rows[(None,)]["total_orders"] == 1


def test_gold_tables_agree_on_revenue(fact):
    def revenue(df, column):
        return df.agg(F.sum(F.col(column).cast("decimal(38,2)"))).first()[0]

    expected = revenue(fact, "total_amount")
    assert expected == D("65.00")
    assert revenue(gold.gold_sales_daily(fact), "total_revenue") == expected
    assert revenue(gold.gold_sales_by_category(fact), "total_revenue") == expected
    assert revenue(gold.gold_customer_summary(fact, AS_OF), "total_spend") == expected


@pytest.mark.parametrize("stored", [False, True])
def test_kpis_count_no_nulls(fact, stored):
    row = views.VIEWS["vw_executive_kpis"].over(fact, stored).first()
    assert (row["total_transactions"], row["unique_customers"]) == (4, 3)
    assert (row["total_revenue"], row["avg_order_value"], row["total_units_sold"]) == (65.0, 13.0, 6)
    assert (row["total_returns"], row["return_rate_pct"]) == (1, 20.0)


@pytest.mark.parametrize("stored", [False, True])
def test_kpis_of_an_empty_fact(fact, stored):
    row = views.VIEWS["vw_executive_kpis"].over(fact.limit(0), stored).first()
    assert (row["total_transactions"], row["unique_customers"]) == (0, 0)
    assert [row[c] for c in ("total_revenue", "profit_margin_pct", "return_rate_pct")] == [None] * 3


def test_monthly_growth_has_no_first_change_and_no_gap_filling(spark, frame):
    trend = frame(
        "year int, month int, month_name string, monthly_revenue double",
        (2023, 1, "January", 100.0), (2022, 12, "December", 0.0), (2023, 3, "March", 150.0),
    )
    rows = [tuple(r)[3:] for r in views.monthly_growth(trend).collect()]
    assert rows == [(0.0, None, None), (100.0, 0.0, None), (150.0, 100.0, 50.0)]


def test_weekend_rows_without_a_day_are_a_second_weekday_row(fact):
    rows = views.weekend_split(fact).collect()
    assert sorted(r["day_type"] for r in rows) == ["Weekday", "Weekday", "Weekend"]
    assert sum(r["total_revenue"] for r in rows) == 65.0


def test_loyalty_shares_add_up(fact):
    rows = by(views.loyalty_breakdown(fact), "loyalty_tier")
    assert {k[0]: r["revenue_pct"] for k, r in rows.items()} == {"Gold": 46.2, "Copper": 46.2, None: 7.7}


def test_top_lists_break_ties_by_key(fact):
    spend = [r["customer_id"] for r in views.VIEWS["vw_top_customers"].over(fact).collect()]
    assert spend == [1, 2, 9, None]
    assert [r["item_name"] for r in views.top_items(fact).collect()] == ["Desk", "Pen", None]


def test_temp_views(spark, fact):
    views.create_temp_views(fact)
    assert spark.table("vw_executive_kpis").first()["total_revenue"] == 65.0
    assert spark.sql("SELECT COUNT(*) FROM vw_store_performance").first()[0] == 2


def test_channel_and_region(fact):
    channel = {r["channel"]: (r["orders"], r["revenue"]) for r in views.revenue_by_channel(fact).collect()}
    assert channel == {"Online": (1, 30.0), "Store": (2, 35.0), None: (1, 0.0)}
    region = {r["region"]: r["store_count"] for r in views.regional_performance(fact).collect()}
    assert region == {"South": 1, None: 1}


def test_quality_report(tables):
    rows = by(quality.report(tables), "table", "check")
    assert len(rows) == 16
    expected = {
        ("customers", "loyalty_tier valid values"): 1,
        ("items", "unit_price > 0"): 1,
        ("items", "cost_price < unit_price"): 1,
        ("txns", "transaction_id unique"): 1,
        ("txns", "total_amount > 0"): 1,
        ("txns", "customer_id ref integrity"): 2,
        ("txns", "item_id ref integrity"): 1,
        ("txns", "store_id ref integrity"): 1,
    }
    assert {k: r["failing"] for k, r in rows.items() if r["status"] == "FAIL"} == expected
    assert rows[("txns", "customer_id ref integrity")]["pass_pct"] == 60.0
    # A null age is not out of range.
    assert rows[("customers", "age between 18 and 100")]["status"] == "PASS"


def test_quality_of_empty_tables(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    rows = quality.report(empty).collect()
    assert {(r["status"], r["failing"], r["total"], r["pass_pct"]) for r in rows} == {
        ("PASS", 0, 0, 100.0)
    }


def test_unique_counts_null_as_one_key(frame):
    df = frame("k int", (1,), (None,), (None,), (2,), (2,))
    row = quality.report({"t": df}, [quality.unique("t", "k")]).first()
    assert (row["failing"], row["total"]) == (2, 5)


def test_not_null_rule_fails(frame):
    df = frame("k int", (1,), (None,))
    row = quality.report({"t": df}, [quality.not_null("t", "k")]).first()
    assert (row["check"], row["status"], row["failing"]) == ("k not null", "FAIL", 1)


def test_gate(tables):
    results = quality.report(tables)
    with pytest.raises(quality.QualityGateError) as caught:
        quality.enforce(results)
    assert len(caught.value.failures) == 8
    assert "txns.transaction_id unique: 1 failing" in str(caught.value)
    assert len(quality.enforce(results, blocking=False)) == 8
    verdict = quality.verdict(results).first()
    assert (verdict["blocked"], verdict["failed_checks"], verdict["checks"]) == (True, 8, 16)
    assert {r["status"]: r["checks"] for r in quality.summary(results).collect()} == {
        "PASS": 8, "FAIL": 8
    }
    clean = quality.report(tables, [quality.unique("stores", "store_id")])
    assert quality.enforce(clean) == []
    assert quality.verdict(clean).first()["blocked"] is False


def test_days_below_target(fact):
    daily = gold.gold_sales_daily(fact)
    rows = {r["full_date"]: r["shortfall"] for r in alerts.days_below(daily, 25).collect()}
    assert rows[datetime.date(2023, 12, 31)] == 5.0
    assert datetime.date(2023, 12, 30) not in rows


def test_calendar_covers_a_stray_date(spark, frame):
    day = datetime.date
    calendar = calendar_over(frame("start date, end date", (day(1995, 1, 1), day(9999, 12, 31))))
    assert calendar.count() == (day(9999, 12, 31) - day(1995, 1, 1)).days + 1
    assert not joins.fits_broadcast(calendar)
    assert joins.fits_broadcast(calendar_between(spark, "1995-01-01", "2024-12-31"))
    empty = frame("start date, end date", (None, None))
    assert calendar_over(empty).count() == 0
    assert calendar_over(empty.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_stray_date_joins_with_and_without_broadcast(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        calendar = calendar_between(spark, "1995-01-01", "9999-12-31")
        lines = spark.sql("SELECT * FROM VALUES (1, 99991231), (2, 19950101), (3, 1) AS t(n, date_id)")
        days = joins.attach(lines, calendar.select("date_id", "full_date"), "date_id")
        found = {r["n"]: r["full_date"] for r in days.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {1: datetime.date(9999, 12, 31), 2: datetime.date(1995, 1, 1), 3: None}


def test_customer_summary_joins_after_the_sums(tables):
    small = gold.star_join(tables["txns"], {k: tables[n] for k, n in (("item_id", "items"), ("date_id", "calendar"))})
    after = gold.gold_customer_summary_of(small, tables["customers"], AS_OF)
    full = gold.gold_fact_sales(*(tables[n] for n in ("txns", "customers", "items", "stores", "calendar")))
    before = gold.gold_customer_summary(full, AS_OF)
    assert after.columns == before.columns
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect()))


def test_top_customers_are_joined_last(tables):
    full = gold.gold_fact_sales(*(tables[n] for n in ("txns", "customers", "items", "stores", "calendar")))
    small = gold.star_join(tables["txns"], {"date_id": tables["calendar"]})
    late = views.top_customers_of(small, tables["customers"])
    early = views.VIEWS["vw_top_customers"].over(full)
    assert late.columns == early.columns
    assert [str(r) for r in late.collect()] == [str(r) for r in early.collect()]


def test_hot_keys_are_looked_for_without_a_join(spark, monkeypatch):
    """With no broadcast at all, no table that is sampled for hot keys holds a join."""
    from tillwright.registry import queries
    from tillwright.sources.star import Star

    sampled = []
    plain = joins.hot_keys

    def watched(df, keys, *args, **kwargs):
        sampled.append(df._jdf.queryExecution().analyzed().toString())
        return plain(df, keys, *args, **kwargs)

    monkeypatch.setattr(joins, "hot_keys", watched)
    monkeypatch.setattr(queries, "hot_keys", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("gold_fact_sales", "join_anti_orphans", "v2_revenue_by_category", "q8_region"):
            queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sampled
    lines = [text for text in sampled if "l_orderkey" in text or "o_orderkey" in text or "lineitem" in text]
    assert lines and not any("Join" in text for text in lines)
    assert Star(spark, "/root/testdata/sf0.001").repeated_keys == ()


@pytest.mark.parametrize("name", ["vw_revenue_by_category", "vw_monthly_trend", "vw_store_performance"])
def test_views_over_a_stored_fact_count_each_column_apart(fact, name):
    lost = fact.withColumns({
        "customer_id": F.when(F.col("quantity") > 1, F.col("customer_id")),
        **{key: F.when(F.col("transaction_id") % 2 == 0, F.col(key)) for key in views.VIEWS[name].keys},
    })
    apart, plain = views.VIEWS[name].over(lost, True), views.VIEWS[name].over(lost)
    assert apart.columns == plain.columns and dict(apart.dtypes) == dict(plain.dtypes)
    assert sorted(map(str, apart.collect())) == sorted(map(str, plain.collect()))
    assert "Expand" not in apart._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("make", [gold.gold_sales_daily, gold.gold_sales_by_category])
def test_summaries_of_a_stored_fact_shuffle_no_sums_by_customer(fact, make):
    lost = fact.withColumns({
        "customer_id": F.when(F.col("transaction_id") > 1, F.col("customer_id")),
        "year": F.when(F.col("quantity") > 1, F.col("year")), "price_band": F.when(F.col("quantity") > 1, F.col("price_band")),
    })
    for rows in (lost, lost.withColumn("customer_id", F.lit(None).cast("long")), lost.limit(0)):
        apart, plain = make(rows, stored=True), make(rows)
        assert apart.columns == plain.columns and dict(apart.dtypes) == dict(plain.dtypes)
        assert sorted(map(str, apart.collect())) == sorted(map(str, plain.collect()))
    assert "count(distinct" not in make(lost, stored=True)._jdf.queryExecution().analyzed().toString().lower()


def test_customer_summary_shuffles_a_row_per_customer(fact):
    made = gold.gold_customer_summary(fact, "2024-06-01")
    plain = {r["customer_id"]: r["n"] for r in fact.groupBy("customer_id").agg(F.count_distinct("category").alias("n")).collect()}
    assert {r["customer_id"]: r["categories_bought"] for r in made.collect()} == plain
    assert "distinct" not in made._jdf.queryExecution().analyzed().toString().lower()


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_a_large_fact_is_joined_in_parts(spark, tables, table, monkeypatch, threshold):
    """All parts at once would hold every line on disk once for each shuffled join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    monkeypatch.setattr(gold, "PART_BYTES", 1)
    try:
        customers, items = tables["customers"], tables["items"]
        twice = customers.unionByName(customers.where("customer_id = 1"))
        dimensions = {"customer_id": table(twice), "item_id": table(items)}
        lines = table(tables["txns"].unionByName(tables["txns"]))
        whole = gold.star_join(lines, dimensions)
        parts = gold.star_join_parts(lines, dimensions)
        assert len(parts) == (12 if threshold == "-1" else 1)
        rows = [[str(r) for r in part.collect()] for part in parts]
        assert sorted(sum(rows, [])) == sorted(str(r) for r in whole.collect())
        keys = [{r["customer_id"] for r in part.select("customer_id").collect()} for part in parts]
        assert sum(map(len, keys)) == len(set().union(*keys))  # all lines of a customer in one part
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
