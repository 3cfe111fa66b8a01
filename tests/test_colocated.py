"""Stored tables that join without an exchange."""

import datetime

import pytest
from pyspark.sql import functions as F

from tillwright.operators import colocated
from tillwright.operators.joins import KINDS, SALT
from tillwright.plans import medallion
from tillwright.registry.queries import QUERIES
from tillwright.schemas import FILE_NAMES
from tillwright.session import work_dir
from tillwright.sources.flat_files import write_flat_file
from tillwright.sources.lake import Lake
from tillwright.sources.star import Star

FOLDER = "/root/testdata/sf0.001"
BUCKETS = 12


def new_lake(spark, name):
    lake = Lake(spark, name, work_dir(spark, name))
    lake.create()
    return lake


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def lines_of(spark, rows=24_000):
    """A third of the rows have key 7, some a null key, some a key the lookup has not."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 11 == 0, None).otherwise(n % 900)
    return spark.range(rows, numPartitions=6).select(key.cast("long").alias("key"), (n % 50).alias("amount"))


def lookup_of(spark):
    """Key 5 twice; keys from 800 are missing."""
    names = spark.range(800).select(F.col("id").alias("key"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    return names.union(spark.sql("SELECT 5L, 'again'"))


@pytest.fixture(scope="module")
def stored(spark):
    lake = new_lake(spark, "beside")
    lake.write(lines_of(spark), "plain")
    layout = colocated.plan_layout(lake.read("plain"), "key", BUCKETS)
    assert colocated.store_lines(lake, lake.read("plain"), "lines", layout) == 24_000
    colocated.store_lookup(lake, lookup_of(spark), "lookup", "lines")
    return lake


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", KINDS)
def test_gives_the_rows_of_the_plain_join(spark, stored, how):
    ours = colocated.join_stored(stored, "lines", "lookup", how)
    assert rows(ours) == rows(lines_of(spark).join(lookup_of(spark), "key", how))


def test_moves_no_row(spark, stored, no_broadcast):
    joined = colocated.join_stored(stored, "lines", "lookup")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = stored.read("plain").join(lookup_of(spark), "key", "left")
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()


def test_hot_and_null_keys_fill_no_bucket(stored):
    held = stored.read("lines").groupBy(F.input_file_name()).count().collect()
    sizes = [r["count"] for r in held]
    assert len(sizes) == BUCKETS
    # Key 7 alone would give one bucket a third of the rows, four times the mean.
    assert max(sizes) < 2.5 * 24_000 / BUCKETS
    assert stored.read("lines").where("key = 7").select(SALT).distinct().count() > 2


def test_later_rows_go_by_the_layout_of_the_table(spark, stored, no_broadcast):
    lake = new_lake(spark, "beside_later")
    lake.write(lines_of(spark), "plain")
    layout = colocated.plan_layout(lake.read("plain"), "key", BUCKETS)
    colocated.store_lines(lake, lake.read("plain"), "lines", layout)
    assert colocated.newly_hot(lake, "lines") == {}
    more = spark.range(30_000).select(F.lit(13).cast("long").alias("key"), (F.col("id") % 9).alias("amount"))
    assert colocated.append_lines(lake, more, "lines") == 30_000
    colocated.store_lookup(lake, lookup_of(spark), "lookup", "lines")
    joined = colocated.join_stored(lake, "lines", "lookup")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(lines_of(spark).union(more).join(lookup_of(spark), "key", "left"))
    assert list(colocated.newly_hot(lake, "lines")) == ["13"]
    count = joined.count()
    lake.write(lake.read("lines").drop(SALT), "plain_later")
    mended = colocated.plan_layout(lake.read("plain_later"), "key", BUCKETS)
    colocated.store_lines(lake, lake.read("plain_later"), "lines", mended)
    assert colocated.newly_hot(lake, "lines") == {}
    with pytest.raises(ValueError, match="not stored by the layout"):
        colocated.join_stored(lake, "lines", "lookup")
    colocated.store_lookup(lake, lookup_of(spark), "lookup", "lines")
    assert colocated.join_stored(lake, "lines", "lookup").count() == count


def test_text_keys_with_quotes(spark):
    lake = new_lake(spark, "beside_text")
    key = F.when(F.col("id") % 2 == 0, "it's \\ \"hot\"").otherwise(F.concat(F.lit("k"), F.col("id")))
    lake.write(spark.range(4000).select(key.alias("key"), "id"), "plain")
    layout = colocated.plan_layout(lake.read("plain"), "key", 4)
    assert layout.hot == ("it's \\ \"hot\"",)
    colocated.store_lines(lake, lake.read("plain"), "lines", layout)
    assert colocated.stored_layout(lake, "lines") == layout
    names = lake.read("plain").select("key").distinct().withColumn("name", F.upper("key"))
    colocated.store_lookup(lake, names, "lookup", "lines")
    assert colocated.join_stored(lake, "lines", "lookup", "inner").where("name = upper(key)").count() == 4000


def test_empty_tables_and_errors(spark):
    lake = new_lake(spark, "beside_empty")
    lake.write(lines_of(spark).limit(0), "plain")
    layout = colocated.plan_layout(lake.read("plain"), "key", 4)
    colocated.store_lines(lake, lake.read("plain"), "lines", layout)
    colocated.store_lookup(lake, lookup_of(spark).limit(0), "lookup", "lines")
    assert colocated.join_stored(lake, "lines", "lookup").count() == 0
    with pytest.raises(ValueError, match="does not support"):
        colocated.join_stored(lake, "lines", "lookup", "full")
    with pytest.raises(ValueError, match="not stored co-located"):
        colocated.store_lookup(lake, lookup_of(spark), "lookup", "plain")
    with pytest.raises(ValueError, match="taken"):
        colocated.store_lines(lake, lines_of(spark).withColumn(SALT, F.lit(0)), "lines", layout)


def test_whole_job(spark, no_broadcast):
    lake, raw_dir = new_lake(spark, "beside_job"), work_dir(spark, "beside-raw")
    for table, df in Star(spark, FOLDER).raw().items():
        write_flat_file(df, f"{raw_dir}/{FILE_NAMES[table]}")
    result = medallion.run_medallion(
        lake, raw_dir, as_of="2001-08-02", gate=False, batch_ts=datetime.datetime(2024, 5, 1), colocate=8,
        partition_by=("year",),
    )
    joined = medallion.fact_with_customers(lake)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == result.rows["gold_fact_sales"]
    assert joined.where("email IS NULL").count() == joined.where("full_name IS NULL").count()
    assert len({r["revenue"] for r in medallion.reconciliation(lake).collect()}) == 1
    with pytest.raises(ValueError, match="append"):
        medallion.run_medallion(lake, raw_dir, append=True, colocate=8)


def test_registered():
    assert {"join_colocated_customer", "medallion_colocated"} <= set(QUERIES)
