"""Flat files to gold, in a shared folder of the test run; the stream alert."""

import datetime
import pathlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tillwright.plans import medallion, quality, views
from tillwright.schemas import CUSTOMER, FILE_NAMES
from tillwright.session import sizing, work_dir
from tillwright.sources.flat_files import read_flat_file, write_flat_file
from tillwright.sources.lake import Lake
from tillwright.sources.star import Star
from tillwright.streaming import revenue_alert

FOLDER = "/root/testdata/sf0.001"
BATCH = datetime.datetime(2024, 5, 1, 2, 0)
CLEAN_RULES = tuple(
    r for r in quality.STANDARD_RULES
    if r.check not in ("transaction_id unique", "loyalty_tier valid values", "cost_price < unit_price")
)


@pytest.fixture(scope="module")
def raw_dir(spark):
    path = work_dir(spark, "raw")
    for table, df in Star(spark, FOLDER).raw().items():
        write_flat_file(df, f"{path}/{FILE_NAMES[table]}")
    return path


def new_lake(spark, database):
    lake = Lake(spark, database, work_dir(spark, database))
    lake.create()
    return lake


def test_run_blocked_by_the_gate_writes_no_gold(spark, raw_dir):
    lake = new_lake(spark, "blocked")
    with pytest.raises(quality.QualityGateError):
        medallion.run_medallion(lake, raw_dir, as_of="2001-08-02", batch_ts=BATCH)
    tables = {t.name for t in spark.catalog.listTables("blocked")}
    assert "silver_transactions" in tables
    assert "quality_report" in tables
    assert not [t for t in tables if t.startswith("gold_")]


def test_full_run(spark, raw_dir):
    lake = new_lake(spark, "full_run")
    result = medallion.run_medallion(
        lake, raw_dir, as_of="2001-08-02", batch_ts=BATCH, rules=CLEAN_RULES,
        partition_by=("year", "month"),
    )
    assert result.failed_checks == []
    for layer in ("bronze", "silver", "gold"):
        audit = {r["table_name"]: r["row_count"] for r in medallion.layer_audit(lake, layer).collect()}
        total = audit.pop("TOTAL")
        assert audit == {k: v for k, v in result.rows.items() if k.startswith(layer)}
        assert total == sum(audit.values())
    assert len({r["revenue"] for r in medallion.reconciliation(lake).collect()}) == 1
    kpis = spark.table("full_run.vw_executive_kpis").first()
    assert kpis["total_revenue"] == medallion.reconciliation(lake).first()["revenue"]
    assert set(lake.read("gold_fact_sales").columns) >= {"_gold_created_at", "year", "month"}
    assert len(lake.read("gold_fact_sales").columns) == 40
    # Again over the same tables: everything is replaced, nothing doubles.
    again = medallion.run_medallion(
        lake, raw_dir, as_of="2001-08-02", batch_ts=BATCH, rules=CLEAN_RULES,
        partition_by=("year", "month"),
    )
    assert again.rows == result.rows
    assert lake.read("gold_fact_sales").count() == result.rows["gold_fact_sales"]


def test_partitioned_fact_is_pruned(spark, raw_dir):
    fact = spark.table("full_run.gold_fact_sales").where("year = 1997 and month = 3")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_catalog_views_answer_sql(spark):
    fact = spark.table("full_run.gold_fact_sales")
    for name, view in views.VIEWS.items():
        written, computed = spark.table(f"full_run.{name}"), view.over(fact)
        assert written.columns == computed.columns
        assert sorted(map(str, written.collect())) == sorted(map(str, computed.collect()))
    top = spark.sql("SELECT * FROM full_run.vw_top_customers").collect()
    assert len(top) == 50
    assert [r["total_spend"] for r in top] == sorted((r["total_spend"] for r in top), reverse=True)
    assert {v for v in views.VIEWS} <= {t.name for t in spark.catalog.listTables("full_run")}


def test_bronze_append_grows_by_batch(spark, raw_dir):
    lake = new_lake(spark, "appending")
    first = medallion.load_bronze(lake, raw_dir, "store_dim", BATCH, append=True)
    later = BATCH + datetime.timedelta(days=1)
    medallion.load_bronze(lake, raw_dir, "store_dim", later, append=True)
    days = lake.read("bronze_store_dim").groupBy("_batch_date").count().collect()
    assert {r["_batch_date"]: r["count"] for r in days} == {
        BATCH.date(): first, later.date(): first
    }


def test_dedup_keeps_the_last_load(spark, raw_dir):
    lake = new_lake(spark, "deduped")
    for days in (0, 1):
        at = BATCH + datetime.timedelta(days=days)
        medallion.load_all_bronze(lake, raw_dir, at, append=True)
    rows = medallion.build_silver(lake, "2001-08-02", dedup=True)
    star = Star(spark, FOLDER)
    assert rows["silver_customer_dim"] == star.table("customer").count()
    assert rows["silver_transactions"] == star.transactions.select("transaction_id").distinct().count()


def test_flat_file_bad_fields_and_corrupt_lines(spark, tmp_path):
    header = ",".join(CUSTOMER.names)
    good = "1,A,B,A B,a@x,1,C,S,USA,30,Male,Gold,2020-01-02,Y"
    bad = "2,A,B,A B,a@x,1,C,S,USA,old,Male,Gold,someday,Y"
    (tmp_path / "c.csv").write_text("\n".join([header, good, bad]) + "\n")
    rows = read_flat_file(spark, str(tmp_path / "c.csv"), CUSTOMER).orderBy("customer_id").collect()
    assert [(r["age"], r["join_date"]) for r in rows] == [(30, datetime.date(2020, 1, 2)), (None, None)]
    kept = read_flat_file(spark, str(tmp_path / "c.csv"), CUSTOMER, keep_corrupt=True)
    corrupt = {r["customer_id"]: r["_corrupt_record"] for r in kept.collect()}
    assert corrupt == {1: None, 2: bad}


def test_flat_file_with_moved_columns_is_an_error(spark, tmp_path):
    names = CUSTOMER.names
    header = ",".join([names[1], names[0], *names[2:]])
    (tmp_path / "c.csv").write_text(header + "\nA,1,B,A B,a@x,1,C,S,USA,30,Male,Gold,2020-01-02,Y\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_flat_file(spark, str(tmp_path / "c.csv"), CUSTOMER).collect()


def test_orc_lake(spark):
    lake = Lake(spark, "orc_lake", work_dir(spark, "orc"), fmt="orc")
    lake.create()
    assert lake.write(spark.range(5).toDF("id"), "numbers") == 5
    assert lake.read("numbers").agg(F.sum("id")).first()[0] == 10


def test_stream_alert_emits_closed_days_once(spark, tmp_path):
    schema = "ts timestamp_ntz, event_type string, value double"
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    elsewhere = spark.newSession()
    elsewhere.conf.set("spark.sql.session.timeZone", "America/New_York")

    def deliver(*rows):
        parsed = [(datetime.datetime.fromisoformat(t), e, v) for t, e, v in rows]
        spark.createDataFrame(parsed, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        session = revenue_alert.stream_session(elsewhere, partitions=4)
        events = revenue_alert.event_stream(session, source, schema)
        revenue_alert.start_alert(events, 100.0, out, checkpoint).awaitTermination()
        rows = spark.read.parquet(out).collect()
        return sorted((r["full_date"].day, r["total_revenue"]) for r in rows)

    deliver(
        ("2024-01-01T10:00:00", "purchase", 30.0), ("2024-01-01T11:00:00", "purchase", 30.5),
        ("2024-01-01T12:00:00", "view", 900.0), ("2024-01-02T10:00:00", "purchase", 500.0),
        ("2024-01-04T00:00:00", "purchase", 10.0),
    )
    # The watermark is one day behind 4 January: days 1 and 2 are closed, day 2 is above target.
    assert run() == [(1, 60.5)]
    # A row for a closed day comes too late; one for an open day counts.
    deliver(
        ("2024-01-01T23:00:00", "purchase", 1.0), ("2024-01-04T09:00:00", "purchase", 5.0),
        ("2024-01-09T00:00:00", "purchase", 1.0),
    )
    assert run() == [(1, 60.5), (4, 15.0)]


def test_sizing_follows_the_input():
    small, large = sizing(10 * 2**30, cores=16), sizing(100 * 2**40, cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "40"
    assert large["spark.sql.shuffle.partitions"] == str(100 * 4096)
    assert sizing(100 * 2**40, 8000, task_bytes=2**30)["spark.sql.shuffle.partitions"] == str(100 * 1024)
    assert sizing(1, cores=16)["spark.sql.shuffle.partitions"] == "32"


def test_work_dir_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(shared)
    assert first != second


@pytest.mark.parametrize("stop_first", [False, True])
def test_no_scratch_is_left(tmp_path, stop_first):
    """A process that runs queries leaves neither folders nor databases behind."""
    script = f"""
import sys
sys.path.insert(0, {str(pathlib.Path(__file__).resolve().parents[1])!r})
from tillwright.registry.queries import QUERIES
from tillwright.session import build_session, clear_work
spark = build_session("scratch", "local[2]", **{{"spark.checkpoint.dir": {str(tmp_path / "shared")!r},
    "spark.sql.warehouse.dir": {str(tmp_path / "warehouse")!r}, "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "2"}})
assert QUERIES["sink_append"](spark, "/root/testdata/sf0.001").count() == 20
assert QUERIES["dq_unique"](spark, "/root/testdata/sf0.001").count() == 3
if {stop_first}:
    spark.stop()
else:
    clear_work(spark.sparkContext.applicationId)
    assert [d.name for d in spark.catalog.listDatabases()] == ["default"]
"""
    subprocess.run([sys.executable, "-c", script], check=True, cwd=tmp_path, timeout=180)
    left = [p for p in (tmp_path / "shared").rglob("*") if p.is_file()] if (tmp_path / "shared").exists() else []
    assert left == []
