"""Daily batches against a plain rebuild: newest batch per key in Python, then the silver and gold functions."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tillwright.plans import gold, medallion, quality, refresh, states
from tillwright.schemas import FILE_NAMES, SOURCES
from tillwright.session import work_dir
from tillwright.sources.calendar import calendar_between
from tillwright.sources.flat_files import write_flat_file
from tillwright.sources.lake import Lake

AS_OF = "2024-06-01"
FIRST = datetime.datetime(2024, 5, 1, 2, 0)


def at(day):
    return FIRST + datetime.timedelta(days=day)


def customer(i, tier="Gold"):
    return (i, "A", "B", f"name {i}", f"c{i}@x", "1", "City", "State", "USA", 20 + i % 50, "Male", tier, datetime.date(2020, 1, 2), "Y")


def item(i, category="Toys"):
    return (i, f"item {i}", category, f"sub {i % 2}", "brand", 10.0 + i, 5.0, 1.0, "Y", datetime.date(2020, 1, 2), 1)


def store(i, region="North"):
    return (i, f"store {i}", "Express", "City", "State", "USA", region, 100, datetime.date(2020, 1, 2), "M", "1", "Y")


def line(t, c=1, i=1, s=1, day=20240501, units=1, total="10.00"):
    return (t, c, i, s, day, units, "10.0000", "0.1000", "1.00", "11.00", "10.00", "0.00", total, "Card", "Online", "NY"[units % 2], "Completed")


def batch(rng, transactions, customers=range(1, 9), tier="Gold", items=range(1, 6), category="Toys"):
    return {
        "customer_dim": [customer(i, tier) for i in customers],
        "item_dim": [item(i, category) for i in items],
        "store_dim": [store(i) for i in (1, 2)],
        "transactions": [
            line(t, rng.choice([1, 2, 3, 8, 77, None]), rng.randint(1, 6), rng.choice([1, 2]), 20240500 + rng.randint(1, 31),
                 rng.randint(1, 4), f"{rng.randint(1, 9999) / 100:.2f}")
            for t in transactions for _ in range(rng.randint(1, 3))
        ],
    }


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(4)
    one = batch(rng, range(1, 30))
    two = batch(rng, [*range(30, 50), 3, 4, None, None], customers=[2, 9], tier="Silver", items=[], category="Toys")
    three = batch(rng, range(50, 60), customers=[], items=[5], category="Books")
    three["store_dim"] = []
    two_again = batch(rng, [*range(30, 45), 4, 5], customers=[2], tier="Bronze", items=[1])  # 3 and others come back
    return one, two, three, two_again


def deliver(spark, lake, contents, day, **settings):
    raw = work_dir(spark, "batch")
    for table, schema in SOURCES.items():
        if table == "time_dim":
            df = calendar_between(spark, "2024-05-01", "2024-05-31")
        else:
            df = as_text(spark, contents[table], schema)
        write_flat_file(df.coalesce(1), f"{raw}/{FILE_NAMES[table]}")
    settings = {"rules": (quality.positive("txns", "total_amount"),), "catalog_views": False, **settings}
    return medallion.run_medallion(lake, raw, as_of=AS_OF, batch_ts=at(day), append=True, **settings)


def as_text(spark, rows, schema):
    """Rows as a flat file spells them."""
    spelled = [tuple(None if v is None else str(v) for v in row) for row in rows]
    return spark.createDataFrame(spelled, ", ".join(f"{name} string" for name in schema.names))


def newest(spark, lake, source):
    """Silver rows by a plain rule: of each key the rows of its newest batch."""
    bronze = lake.read(source.bronze)
    best = {}
    for r in bronze.select(source.key, refresh.BATCH).collect():
        if r[0] is not None:
            best[r[0]] = max(best.get(r[0], r[1]), r[1])
    rows = [r for r in bronze.collect() if r[source.key] is None or best[r[source.key]] == r[refresh.BATCH]]
    return source.refine(spark.createDataFrame(rows, bronze.schema))


def plain_rows(df):
    columns = [c for c in df.columns if c not in ("_updated_at", "_gold_created_at", refresh.BATCH)]
    return sorted((str([r[c] for c in columns]) for r in df.collect()))


def assert_like_a_rebuild(spark, lake):
    silver = {s.table: newest(spark, lake, s) for s in medallion.batch_sources(AS_OF)}
    for table, df in silver.items():
        assert plain_rows(lake.read(f"silver_{table}")) == plain_rows(df), table
    fact = gold.gold_fact_sales(
        silver["transactions"], silver["customer_dim"], silver["item_dim"], silver["store_dim"], silver["time_dim"]
    )
    expected = {
        "gold_fact_sales": fact, "gold_sales_daily": gold.gold_sales_daily(fact),
        "gold_sales_by_category": gold.gold_sales_by_category(fact),
        "gold_customer_summary": gold.gold_customer_summary(fact, AS_OF),
    }
    for name, df in expected.items():
        assert plain_rows(lake.read(name).select(*df.columns)) == plain_rows(df), name
    assert refresh.pending(lake) == []


def new_lake(spark, name):
    lake = Lake(spark, name, work_dir(spark, name))
    lake.create()
    return lake


def test_batches_one_after_the_other_equal_a_rebuild(spark, batches):
    one, two, three, two_again = batches
    lake = new_lake(spark, "daily")
    deliver(spark, lake, one, 0)
    assert_like_a_rebuild(spark, lake)
    deliver(spark, lake, two, 1)
    assert_like_a_rebuild(spark, lake)
    deliver(spark, lake, three, 2)
    assert_like_a_rebuild(spark, lake)
    # The second day again with other rows: keys it no longer has come back from the first.
    deliver(spark, lake, two_again, 1)
    assert_like_a_rebuild(spark, lake)
    tables = {t: plain_rows(lake.read(t)) for t in medallion.GOLD_TABLES}
    deliver(spark, lake, two_again, 1)
    assert tables == {t: plain_rows(lake.read(t)) for t in medallion.GOLD_TABLES}


def test_late_batch_and_blocked_run(spark, batches):
    one, two, three, _ = batches
    lake = new_lake(spark, "late")
    deliver(spark, lake, one, 0)
    blocking = (quality.positive("txns", "total_amount"), quality.within("txns", "quantity", 100, 200))
    before = plain_rows(lake.read("gold_fact_sales"))
    with pytest.raises(quality.QualityGateError):
        deliver(spark, lake, three, 2, rules=blocking)
    assert plain_rows(lake.read("gold_fact_sales")) == before and refresh.pending(lake)
    # An older batch comes late; its run makes good for the blocked one, too.
    deliver(spark, lake, two, 1)
    assert_like_a_rebuild(spark, lake)


def test_second_batch_reads_its_own_partitions_only(spark, batches):
    one, two, three, _ = batches
    lake = new_lake(spark, "pruned")
    for day, contents in enumerate((one, two)):
        deliver(spark, lake, contents, day)
    rng = random.Random(9)
    new = batch(rng, range(70, 75), customers=[9], tier="Silver", items=[])
    new["transactions"] += [line(31)]  # a line of the second day comes again
    raw = work_dir(spark, "batch")
    for table in ("transactions", "customer_dim"):
        df = as_text(spark, new[table], SOURCES[table])
        write_flat_file(df.coalesce(1), f"{raw}/{FILE_NAMES[table]}")
        medallion.load_bronze(lake, raw, table, at(2), append=True)
    days = [at(d).date() for d in range(3)]
    sources = {s.table: s for s in medallion.batch_sources(AS_OF)}

    def files(df, table):
        return {f.split(f"{refresh.BATCH}=")[1].split("/")[0] for f in df.inputFiles() if f"/{table}/" in f}

    step = refresh.plan_step(lake, sources["transactions"], days[2])
    assert step.days == (days[1], days[2])
    assert files(refresh.silver_rows(lake, step, days[2]), "bronze_transactions") == {str(days[2])}
    assert files(refresh.silver_rows(lake, step, days[1]), "bronze_transactions") == {str(days[1])}
    tables = medallion.silver_tables(lake)
    assert files(refresh.fact_rows(lake, tables, [days[1]]), "silver_transactions") == {str(days[1])}
    for grain in states.GRAINS:
        assert files(refresh.state_rows(lake, grain, [days[1]]), "gold_fact_sales") == {str(days[1])}
    # Customer 9 as it was: no partition of the fact is joined again for it.
    step = refresh.plan_step(lake, sources["customer_dim"], days[2])
    assert step.days == (days[1], days[2])
    assert refresh.changed_keys(lake, step, "customer_id").count() == 0


def test_states_of_parts_merge_to_the_whole(spark, batches):
    lake = new_lake(spark, "merging")
    deliver(spark, lake, batches[0], 0)
    fact = lake.read("gold_fact_sales").drop(refresh.BATCH, "_gold_created_at")
    parts = [fact.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == n) for n in range(3)]

    def stored(grain):
        rows = states.state(parts[0], grain)
        for part in parts[1:]:
            rows = rows.unionByName(states.state(part, grain))
        return rows

    pairs = [
        (states.sales_daily(stored("daily")), gold.gold_sales_daily(fact)),
        (states.sales_by_category(stored("category")), gold.gold_sales_by_category(fact)),
        (states.customer_summary(stored("customer"), AS_OF), gold.gold_customer_summary(fact, AS_OF)),
    ]
    for made, expected in pairs:
        assert made.columns == expected.columns
        assert dict(made.dtypes) == dict(expected.dtypes)
        assert plain_rows(made) == plain_rows(expected)
        assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    assert states.sales_daily(stored("daily").limit(0)).count() == 0


def test_append_and_partition_by_do_not_mix(spark):
    with pytest.raises(ValueError, match="partitioned by batch"):
        medallion.run_medallion(Lake(spark, "mixed"), "/nowhere", append=True, partition_by=("year",))


def test_states_keep_few_rows_and_older_ones_are_made_anew(spark, batches):
    lake = new_lake(spark, "state_form")
    deliver(spark, lake, batches[0], 0)
    fact = lake.read("gold_fact_sales")
    per_customer = states.state(fact, "customer")
    assert per_customer.count() == fact.select(*gold.CUSTOMER_KEYS).distinct().count()
    daily = states.state(fact, "daily")
    assert daily.where("bucket is null").count() == fact.select(*gold.DAILY_KEYS).distinct().count()
    assert daily.where("bucket is not null and lines is not null").count() == 0
    assert refresh.gold_days(lake) == []
    lake.write(lake.read("state_customer").withColumn("category", F.lit("x")).drop("categories"), "older")
    lake.write(lake.read("older"), "state_customer", partition_by=[refresh.BATCH])
    assert refresh.gold_days(lake) is None
