"""Joins, duplicate removal and audits against brute force, skewed keys included."""

import random

import pytest
from pyspark.sql import functions as F

from tillwright.operators import bitmaps, joins
from tillwright.operators.audit import row_counts
from tillwright.operators.dedup import distinct_values, latest_per_key, newest_rows
from tillwright.operators.ranking import rank_all

HOT = 7


@pytest.fixture
def skewed(frame):
    """A third of the rows share one key, a sixth have no key, one row comes 200 times."""
    rng = random.Random(5)
    rows = [(i, HOT if i % 3 == 0 else None if i % 6 == 1 else rng.randrange(40)) for i in range(900)]
    rows += [(9999, HOT)] * 200
    return rows, frame("id int, k int", *rows).repartition(8)


@pytest.fixture
def lookup(frame):
    # Key 7 comes twice, keys 30.. are missing, one key is null.
    rows = [(k, f"name{k}") for k in range(30)] + [(HOT, "again"), (None, "nobody")]
    return rows, frame("k int, name string", *rows)


def expected_join(left, right, how):
    out = []
    for i, k in left:
        names = [n for key, n in right if key == k and k is not None]
        out += [(k, i, n) for n in names] or ([(k, i, None)] if how == "left" else [])
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "id", "name").collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_brute_force(skewed, lookup, how):
    hot = joins.hot_keys(skewed[1], ["k"], share=0.05, sample=1.0)["k"]
    joined = joins.salted_join(skewed[1], lookup[1], "k", how, hot)
    assert joined.columns == ["k", "id", "name"]
    assert rows_of(joined) == expected_join(skewed[0], lookup[0], how)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_all_join_routes_agree(skewed, lookup, table, how):
    left, right = table(skewed[1]), table(lookup[1])
    expected = expected_join(skewed[0], lookup[0], how)
    assert rows_of(joins.attach(left, right, "k", how)) == expected
    assert rows_of(joins.attach(left, right, "k", how, broadcast_limit=0)) == expected


def test_salted_join_rejects_other_kinds(skewed, lookup):
    with pytest.raises(ValueError, match="full"):
        joins.salted_join(skewed[1], lookup[1], "k", "full")


def test_broadcast_only_where_the_size_is_known(spark, frame, table):
    unknown, known = frame("k int", (1,)), table(frame("k int", (1,)))
    assert not joins.fits_broadcast(unknown)
    assert joins.fits_broadcast(known)
    assert not joins.fits_broadcast(known, limit=1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not joins.fits_broadcast(known)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_keys_of_several_columns_at_once(skewed):
    df = skewed[1].withColumn("j", F.when(F.col("id") < 300, F.lit("x")).otherwise(F.col("id").cast("string")))
    hot = joins.hot_keys(df, ["k", "j"], share=0.2, sample=1.0)
    rows = len(skewed[0])
    assert hot["k"] == {HOT: [k for _, k in skewed[0]].count(HOT) / rows}
    assert hot["j"] == {"x": 300 / rows}
    assert joins.hot_keys(df.limit(0), ["k"], sample=1.0) == {"k": {}}


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_salted_semi_and_anti_join(skewed, lookup, how):
    known = {k for k, _ in lookup[0] if k is not None}
    expected = sorted(i for i, k in skewed[0] if (k in known) == (how == "left_semi"))
    joined = joins.salted_join(skewed[1], lookup[1], "k", how, {HOT: 0.4})
    assert joined.columns == ["k", "id"]
    assert sorted(r["id"] for r in joined.collect()) == expected


def test_hot_rows_spread_over_many_partitions(spark, skewed, lookup):
    """The rows of the hot key, identical copies included, do not end in one task."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        hot = joins.hot_keys(skewed[1], ["k"], share=0.05, sample=1.0)["k"]
        joined = joins.salted_join(skewed[1], lookup[1], "k", "left", hot)
        per_task = (
            joined.withColumn("task", F.spark_partition_id()).groupBy("k", "task").count().collect()
        )
        plain = skewed[1].join(lookup[1], "k", "left").withColumn("task", F.spark_partition_id())
        plain_tasks = plain.where(F.col("k") == HOT).select("task").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plain_tasks == 1
    assert len([r for r in per_task if r["k"] == HOT]) > 1
    assert len([r for r in per_task if r["k"] is None]) > 1


def test_orphans_and_their_count(skewed, lookup):
    known = {k for k, _ in lookup[0] if k is not None}
    missing = [i for i, k in skewed[0] if k not in known]
    found = joins.orphans(skewed[1], lookup[1], "k")
    assert sorted(r["id"] for r in found.collect()) == sorted(missing)
    counted = joins.orphan_count(skewed[1], lookup[1], "k").first()
    assert (counted["failing"], counted["total"]) == (len(missing), len(skewed[0]))


def test_orphan_count_of_nothing(skewed, lookup):
    counted = joins.orphan_count(skewed[1].limit(0), lookup[1], "k").first()
    assert (counted["failing"], counted["total"]) == (0, 0)


def test_latest_per_key(frame):
    df = frame(
        "k int, at int, v string",
        (1, 1, "old"), (1, 2, "new"), (1, 2, "newer"), (2, None, "only"), (None, 5, "nokey"),
        (1, None, "undated"),
    )
    kept = latest_per_key(df, ["k"], ["at"])
    assert kept.columns == df.columns
    assert {tuple(r) for r in kept.collect()} == {
        (1, 2, "newer"), (2, None, "only"), (None, 5, "nokey")
    }


def test_distinct_values_keep_null(frame):
    df = frame("k int", (1,), (1,), (None,), (None,))
    assert {r["k"] for r in distinct_values(df, "k").collect()} == {1, None}


def test_row_counts_with_total(frame):
    df = frame("k int", (1,), (2,))
    counts = {r["table_name"]: r["row_count"] for r in row_counts({"a": df, "b": df.limit(0)}).collect()}
    assert counts == {"a": 2, "b": 0, "TOTAL": 2}


def test_rows_without_a_key_survive_duplicate_removal(frame):
    df = frame("k int, t int, v string", (None, 1, "a"), (None, 1, "a"), (1, 1, "a"), (1, 2, "b"), (2, 1, "c"))
    left = sorted(map(tuple, latest_per_key(df, ["k"], ["t"]).collect()), key=str)
    assert left == sorted([(None, 1, "a"), (None, 1, "a"), (1, 2, "b"), (2, 1, "c")], key=str)


def test_single_keys_are_not_aggregated(frame):
    df = frame("k int, t int, v string", (None, 1, "a"), (1, 1, "a"), (2, 1, "c"))
    plan = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_duplicate_removal_beyond_the_broadcast_bound(frame, monkeypatch):
    monkeypatch.setattr("tillwright.operators.dedup.FEW_KEYS", 0)
    df = frame("k int, t int", (1, 1), (1, 3), (2, 5), (None, 7))
    assert sorted(map(tuple, latest_per_key(df, ["k"], ["t"]).collect()), key=str) == [(1, 3), (2, 5), (None, 7)]


def test_latest_row_is_one_scan_that_combines_before_the_shuffle(frame, table):
    df = table(frame("k int, t int, v string", (1, 1, "a"), (1, 2, "b"), (None, 1, "c")))
    latest = latest_per_key(df, ["k"], ["t"])
    assert sorted(map(tuple, latest.collect()), key=str) == sorted([(1, 2, "b"), (None, 1, "c")], key=str)
    plan = latest._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    before, after = plan.split("Exchange")
    assert "WindowGroupLimit" in before and "Partial" in after and "SortAggregate" not in plan


def test_latest_row_of_a_hot_key_against_brute_force(frame):
    rng = random.Random(8)
    rows = [(HOT if i % 3 == 0 else None if i % 7 == 1 else rng.randrange(30), rng.choice([None, 1, 2, 3]), rng.choice("ab")) for i in range(900)]
    rows += [(HOT, 3, "b")] * 50
    best = {}
    for k, t, v in rows:
        if k is not None:
            best[k] = max(best.get(k, (False, 0, "")), (t is not None, t or 0, v))
    expected = [(k, t if known else None, v) for k, (known, t, v) in best.items()] + [r for r in rows if r[0] is None]
    found = latest_per_key(frame("k int, t int, v string", *rows).repartition(6), ["k"], ["t"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("few", [0, 100])
def test_newest_rows_keep_all_of_the_newest_batch(frame, monkeypatch, few):
    monkeypatch.setattr("tillwright.operators.dedup.FEW_KEYS", few)
    rows = [(HOT if i % 3 == 0 else None if i % 6 == 1 else i % 40, i // 300, i) for i in range(900)] + [(99, None, 1), (99, None, 2)]
    newest = {}
    for k, b, _ in rows:
        newest[k] = max(newest.get(k, -1), -1 if b is None else b)
    expected = [r for r in rows if r[0] is None or (-1 if r[1] is None else r[1]) == newest[r[0]]]
    found = newest_rows(frame("k int, b int, v int", *rows).repartition(5), "k", "b")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_key_sets_are_exact(frame, monkeypatch):
    keys = [None, 0, 1, 2, -1, -5, 32767, 32768, 32769, 65536, -32768, -32769, 2**62, -2**62, 100, 101, 101]
    df = frame("g string, k long", *[("ab"[i % 2], k) for i, k in enumerate(keys)])
    for group in "ab":
        own = [k for i, k in enumerate(keys) if "ab"[i % 2] == group]
        sets = bitmaps.key_sets(df.where(f"g = '{group}'"), "k")
        assert bitmaps.distinct_count(sets).first()["n"] == len(set(own) - {None})
        left = [k for k in keys if k is None or k not in own]
        for limit in (1 << 25, 0):  # broadcast, then shuffled by bucket
            monkeypatch.setattr(bitmaps, "BROADCAST_LIMIT_BYTES", limit)
            assert sorted((r["k"] for r in bitmaps.without(df, "k", sets).collect()), key=str) == sorted(left, key=str)
    per_group = bitmaps.key_sets(df, "k", "g")
    merged = bitmaps.united(per_group)
    assert bitmaps.distinct_count(merged).first()["n"] == len(set(keys) - {None})
    counts = {r["g"]: r["n"] for r in bitmaps.distinct_count(per_group, "g").collect()}
    assert counts == {g: len({k for i, k in enumerate(keys) if "ab"[i % 2] == g} - {None}) for g in "ab"}
    other = bitmaps.key_sets(frame("k long", (65536,), (7,)), "k")
    holder = "ab"[keys.index(65536) % 2]
    assert [r["g"] for r in bitmaps.meeting(per_group, other, "g").collect()] == [holder]
    assert bitmaps.key_sets(df.limit(0), "k").count() == 0


def test_rank_by_ranges(frame, spark):
    rng = random.Random(3)
    values = [HOT if i % 3 == 0 else None if i % 10 == 1 else rng.randrange(200) for i in range(900)]
    order = sorted(values, key=lambda v: (v is None, -(v or 0)))
    first = {}
    for place, v in enumerate(order, 1):
        first.setdefault(v, place)
    df = frame("i int, v int", *enumerate(values)).repartition(6)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    for coalesced in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
        ranked = rank_all(df, "v")
        assert sorted((r["i"], r["rank"]) for r in ranked.collect()) == [(i, first[v]) for i, v in enumerate(values)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window [" in plan and "SinglePartition" not in plan
    assert rank_all(df.limit(0), "v").count() == 0


def test_bitmaps_are_made_where_a_bucket_meets(spark):
    keys = spark.range(0, 300_000, 7, 20).withColumn("g", F.col("id") % 3)
    sets = bitmaps.key_sets(keys, "id", "g")
    assert bitmaps.distinct_count(sets, "g").agg(F.sum("n")).first()[0] == keys.count()
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" not in plan[plan.index("Exchange hashpartitioning"):]  # none per map task
