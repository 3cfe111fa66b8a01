"""Publishing without a gap, lines kept apart, runs that go on where they stopped."""

import datetime
import pathlib
import shutil
import threading
import time

import pytest
from pyspark.sql import functions as F

from tillwright.operators.joins import fits_broadcast
from tillwright.plans import gold, medallion, quality, refresh
from tillwright.registry import queries
from tillwright.registry.queries import QUERIES
from tillwright.schemas import FILE_NAMES, STORE
from tillwright.session import TIDY, tidy, work_dir
from tillwright.sources.flat_files import read_flat_file, readable, unreadable, write_flat_file
from tillwright.sources.lake import Lake
from tillwright.sources.star import Star
from tillwright.streaming import revenue_alert

FOLDER = "/root/testdata/sf0.001"
BATCH = datetime.datetime(2024, 5, 1, 2, 0)
GOOD_RULES = (quality.positive("txns", "total_amount"),)


def new_lake(spark, name):
    lake = Lake(spark, name, work_dir(spark, name))
    lake.create()
    return lake


@pytest.fixture(scope="module")
def raw_dir(spark):
    path = work_dir(spark, "raw")
    for table, df in Star(spark, FOLDER).raw().items():
        write_flat_file(df, f"{path}/{FILE_NAMES[table]}")
    return path


def version(spark, number, rows=2000):
    return spark.range(rows, numPartitions=4).select("id", F.lit(number).alias("version"))


def test_readers_see_whole_versions_while_a_table_is_published(spark):
    lake = new_lake(spark, "publishing")
    lake.publish(version(spark, 0), "numbers")
    seen, failed, stop = [], [], threading.Event()

    def read():
        session = spark.newSession()
        while not stop.is_set():
            try:
                seen.append([tuple(r) for r in session.table("publishing.numbers").groupBy("version").count().collect()])
            except Exception as error:  # any failure of a reader is what this test looks for
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for number in range(1, 7):
        assert lake.publish(version(spark, number), "numbers") == 2000
    stop.set()
    reader.join()
    assert not failed
    assert seen and all(len(s) == 1 and s[0][1] == 2000 for s in seen)
    order = [s[0][0] for s in seen]
    assert order == sorted(order)
    assert lake.read("numbers").select("version").distinct().collect()[0][0] == 6


def test_old_versions_go_and_columns_may_change(spark):
    lake = new_lake(spark, "versions")
    for number in range(4):
        lake.publish(version(spark, number, 10), "numbers", grace=0 if number == 3 else 3600)
    top = pathlib.Path(lake.root.removeprefix("file://")) / "numbers-versions"
    assert len([p for p in top.iterdir() if p.is_dir()]) == 1
    lake.publish(version(spark, 9, 5).withColumn("more", F.lit("x")), "numbers")
    assert lake.read("numbers").columns == ["id", "version", "more"] and lake.read("numbers").count() == 5
    lake.publish(version(spark, 9, 5).limit(0), "numbers")
    assert lake.read("numbers").count() == 0
    with pytest.raises(ValueError, match="root"):
        Lake(spark, "versions").publish(version(spark, 1), "numbers")


def test_bad_lines_and_why(spark, tmp_path):
    header = ",".join(STORE.names)
    good = "1,N,T,C,S,X,R,100,2020-01-02,M,1,Y"
    lines = [
        good, "2,N,T,C,S,X,R,many,2020-01-02,M,1,Y", "3,N,T,C,S,X,R,many,soon,M,1,Y", "4,N,T", good + ",more",
        "x,\"quoted, name\",T,C,S,X,R,100,2020-01-02,M,1,Y", "5,,,,,,,,,,,",
    ]
    (tmp_path / "s.csv").write_text("\n".join([header, *lines]) + "\n")
    rows = read_flat_file(spark, str(tmp_path / "s.csv"), STORE, keep_corrupt=True)
    assert sorted(r["store_id"] for r in readable(rows).collect()) == [1, 5]
    found = {r["line"]: r["reason"] for r in unreadable(rows).collect()}
    assert found == {
        lines[1]: "does not parse: sq_footage", lines[2]: "does not parse: sq_footage, open_date",
        lines[3]: "wrong number of fields", lines[4]: "wrong number of fields", lines[5]: "does not parse: store_id",
    }


def test_quarantined_lines_add_up_and_are_a_check(spark, raw_dir):
    lake = new_lake(spark, "quarantined")
    result = medallion.run_medallion(
        lake, raw_dir, as_of="2001-08-02", batch_ts=BATCH, rules=GOOD_RULES, quarantine=True, catalog_views=False
    )
    assert result.failed_checks == []
    store = f"{raw_dir}/{FILE_NAMES['store_dim']}"
    stores = Star(spark, FOLDER).stores
    broken = stores.withColumn("sq_footage", F.when(F.col("store_id") <= 3, "big").otherwise(F.col("sq_footage").cast("string")))
    write_flat_file(broken, store)
    try:
        with pytest.raises(quality.QualityGateError):
            medallion.run_medallion(
                lake, raw_dir, as_of="2001-08-02", batch_ts=BATCH, rules=GOOD_RULES, quarantine=True, catalog_views=False
            )
    finally:
        write_flat_file(stores, store)
    report = {r["table"]: (r["status"], r["failing"], r["total"]) for r in lake.read("quality_report").where("check = 'lines readable'").collect()}
    total, bad = stores.count(), stores.where("store_id <= 3").count()
    assert 0 < bad < total and report["bronze_store_dim"] == ("FAIL", bad, total) and report["bronze_item_dim"][0] == "PASS"
    assert lake.read("bronze_store_dim").count() + lake.read("quarantine_store_dim").count() == total
    kept = lake.read("quarantine_store_dim").first()
    assert kept["_source_file"] == FILE_NAMES["store_dim"] and kept["reason"] == "does not parse: sq_footage"


def test_a_run_goes_on_where_it_failed(spark, raw_dir, monkeypatch):
    lake = new_lake(spark, "resumed")

    def broken(*_args, **_settings):
        raise RuntimeError("no gold today")

    with monkeypatch.context() as patch:
        patch.setattr(medallion, "build_gold", broken)
        with pytest.raises(RuntimeError, match="no gold today"):
            medallion.run_medallion(lake, raw_dir, as_of="2001-08-02", batch_ts=BATCH, rules=GOOD_RULES, catalog_views=False)
    assert medallion.finished_stages(lake, BATCH) == {"bronze", "silver", "checks"}
    before = sorted(lake.read("silver_store_dim").inputFiles())
    result = medallion.run_medallion(
        lake, raw_dir, as_of="2001-08-02", batch_ts=BATCH, rules=GOOD_RULES, catalog_views=False, resume=True
    )
    assert sorted(lake.read("silver_store_dim").inputFiles()) == before
    assert set(result.rows) == set(medallion.GOLD_TABLES)
    assert medallion.finished_stages(lake, BATCH) == set(medallion.STAGES)
    # Another batch has finished nothing, and without resume everything runs.
    assert medallion.finished_stages(lake, BATCH + datetime.timedelta(days=1)) == set()
    with pytest.raises(ValueError, match="batch_ts"):
        medallion.run_medallion(lake, raw_dir, resume=True)


def test_repeated_events_count_once(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def deliver(*rows):
        parsed = [(i, datetime.datetime.fromisoformat(t), "purchase", v) for i, t, v in rows]
        spark.createDataFrame(parsed, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        session = revenue_alert.stream_session(spark, partitions=4)
        events = revenue_alert.event_stream(session, source, schema)
        revenue_alert.start_alert(events, 100.0, out, checkpoint, once_by="event_id").awaitTermination()
        return sorted((r["full_date"].day, r["total_revenue"]) for r in spark.read.parquet(out).collect())

    first = ((1, "2024-01-01T10:00:00", 30.0), (2, "2024-01-01T11:00:00", 20.0), (3, "2024-01-02T10:00:00", 40.0))
    deliver(*first, (1, "2024-01-01T10:00:00", 30.0))
    assert run() == []
    deliver(*first, (4, "2024-01-05T00:00:00", 1.0))
    assert run() == [(1, 50.0), (2, 40.0)]


def test_distinct_counts_by_bitmaps_multiply_no_row(spark):
    plan = QUERIES["agg_distinct_bitmaps"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    by_query = QUERIES["agg_count_distinct"](spark, FOLDER)
    assert by_query.count() > 0


def test_a_partition_is_written_as_its_rows_lie(spark):
    lake = Lake(spark, "as_it_lies", work_dir(spark, "as-it-lies"))
    lake.create()
    rows = spark.range(0, 400, 1, 4).withColumn("day", F.lit("2024-05-01").cast("date"))
    for _ in range(2):
        assert lake.replace_partition(rows, "numbers", "day", "2024-05-01") == 400
        assert lake.read("numbers").select(F.input_file_name()).distinct().count() == 4  # one a task, without an exchange
    assert lake.read("numbers").agg(F.sum("id")).first()[0] == sum(range(400))


@pytest.mark.parametrize("codec, ending", [("snappy", ".csv.snappy"), ("gzip", ".csv.gz")])
def test_flat_files_are_compressed(spark, tmp_path, codec, ending):
    rows = spark.range(50).select(F.col("id").cast("string").alias("store_id"), F.lit("a, b").alias("store_name"))
    write_flat_file(rows, str(tmp_path / "s"), codec)
    assert all(p.name.endswith(ending) for p in (tmp_path / "s").glob("part-*"))
    back = read_flat_file(spark, str(tmp_path / "s"), rows.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark):
    """They stayed until the driver's garbage was collected, so a job held those of all its steps."""
    lake, before = new_lake(spark, "tidied"), spark.conf.get(TIDY, None)
    old = shuffle_files(spark)
    with tidy(spark):
        lake.write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
        with tidy(spark):
            pass
        assert spark.conf.get(TIDY) == "true"
    assert spark.conf.get(TIDY, None) == before
    until = time.monotonic() + 30
    while shuffle_files(spark) - old and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - old
    assert lake.read("sums").agg(F.sum("count")).first()[0] == 1000


@pytest.mark.parametrize("clear", [True, False])
def test_loaded_files_are_cleared_if_asked(spark, raw_dir, tmp_path, clear):
    raw = tmp_path / "raw"
    shutil.copytree(raw_dir, raw)
    lake = new_lake(spark, f"cleared_{clear}")
    medallion.run_medallion(lake, str(raw), as_of="2024-06-01", rules=GOOD_RULES, batch_ts=BATCH, clear_raw=clear)
    assert [p.name for p in raw.iterdir() if p.name in FILE_NAMES.values()] == [] if clear else len(list(raw.iterdir())) >= 5
    assert lake.read("bronze_transactions").count() == lake.read("gold_fact_sales").count() > 0


def test_frames_written_one_after_the_other(spark):
    lake = new_lake(spark, "frames")
    frames = [spark.range(10 * n, 10 * n + 4).selectExpr("id", "date'2024-01-01' as day") for n in range(3)]
    assert lake.write(frames, "plain") == 12
    assert lake.write(frames, "plain") == 12 and lake.read("plain").count() == 12
    assert lake.replace_partition(frames, "days", "day", "2024-01-01") == 12
    assert lake.replace_partition(frames[:2], "days", "day", "2024-01-01") == 8
    assert sorted(r["id"] for r in lake.read("days").collect()) == [0, 1, 2, 3, 10, 11, 12, 13]


def test_lookups_kept_per_batch_have_a_size(spark):
    """Without one a lookup of any size was shuffled, and hot keys were looked for in no row."""
    lake = new_lake(spark, "sized")
    lake.write(spark.range(100).selectExpr("id", "date'2024-01-01' as _batch_date"), "lookup", partition_by=["_batch_date"])
    assert not fits_broadcast(lake.read("lookup"))
    assert fits_broadcast(refresh.read_sized(lake, "lookup")) and refresh.read_sized(lake, "lookup").count() == 100


def test_catalog_over_large_lookups_is_the_same(spark, monkeypatch):
    """The lines are stored, joined in parts and removed; three joins of all lines at once filled the disk."""
    names, key = ("catalog_top_customers", "catalog_store_performance"), "spark.sql.autoBroadcastJoinThreshold"
    found, before = [], spark.conf.get(key)
    monkeypatch.setattr(gold, "PART_BYTES", 1)
    for threshold in (before, "-1"):
        monkeypatch.setattr(queries, "_catalogs", {})
        spark.conf.set(key, threshold)
        try:
            found.append([sorted(map(str, QUERIES[name](spark, FOLDER).collect())) for name in names])
        finally:
            spark.conf.set(key, before)
        (lake,) = queries._catalogs.values()
        files = lake.read("gold_fact_sales").inputFiles()
        assert not pathlib.Path(lake.root.removeprefix("file://").removeprefix("file:"), "lines").exists()
    assert found[0] == found[1] and all(found[0]) and len(files) > 12
