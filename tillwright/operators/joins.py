"""Equi-joins of a large side with a lookup side.

Three ways, in this order:

1. the lookup side is broadcast, but only where the size of everything it reads is known and
   below a limit;
2. beyond that both sides are shuffled, and the rows of keys that hold a large share of the
   left side are spread over many tasks (salted);
3. what skew is left is split by adaptive execution (`spark.sql.adaptive.skewJoin`).

All three return the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("left", "inner", "left_semi", "left_anti")
SALT = "_salt"

#: Lookup sides that read at most this much are broadcast. Parquet grows several times in
#: memory, so this stays far below what an executor can hold.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

#: A key is hot once it holds this share of the rows, so at most 1 / share keys are hot.
HOT_SHARE = 0.005

#: About how many rows are looked at to find hot keys, whatever the size of the table. Only the
#: spread of work depends on it, never the result.
HOT_ROWS = 200_000
#: Bytes a stored row of keys takes at least; turns known sizes into a bound on rows.
KEY_BYTES = 8


def scanned_bytes(df: DataFrame) -> int | None:
    """Size of all that `df` reads, by Catalyst's statistics; None where there are none.

    For a lookup built by many-to-one joins this bounds the result, whereas Catalyst's own
    estimate for a join multiplies the sides and so never allows a broadcast.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    execution = plan.queryExecution()
    found = execution.optimizedPlan().collectLeaves()  # of partitioned tables only what conditions leave
    leaves = [found.apply(i) for i in range(found.size())]
    if any(leaf.nodeName() == "Range" for leaf in leaves):
        # Generated rows have the width of the result, not that of the numbers they come from.
        return max(int(execution.optimizedPlan().stats().sizeInBytes()), sum(_bytes(x) for x in leaves))
    return sum(_bytes(leaf) for leaf in leaves)


def _bytes(leaf) -> int:
    return int(leaf.stats().sizeInBytes())


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    if str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).startswith("-"):
        return False
    size = scanned_bytes(df)
    return size is not None and size <= limit


def attach(
    left: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "left",
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    hot: Mapping | None = None,
) -> DataFrame:
    """`left` joined with `lookup`; `how` is one of :data:`KINDS`.

    `hot` gives hot keys found before, with their shares; without it they are looked for where both
    sides must be shuffled, for which `left` should be a table before its joins.
    """
    if fits_broadcast(lookup, broadcast_limit):
        return left.join(F.broadcast(lookup), on, how)
    if hot is None:
        hot = hot_keys(left, [on])[on]
    return salted_join(left, lookup, on, how, hot)


def sample_share(df: DataFrame, rows: int = HOT_ROWS) -> float:
    """A share of `df` that holds about `rows` rows or more, as far as its size is known."""
    size = scanned_bytes(df)
    return min(1.0, rows * KEY_BYTES * 8 / size) if size else 1.0


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, sample: float | None = None
) -> dict[str, dict]:
    """For each key column, its values holding at least `share` of the sampled rows.

    One job over the key columns alone, for all of them at once; at most 1 / share values per
    column reach the driver. Give it the table before its joins, so that none is run for this.
    """
    sample = sample_share(df) if sample is None else sample
    everything = 2 ** len(keys) - 1
    sets = [[key] for key in keys]
    heaviest = (
        df.select(*keys)
        .sample(fraction=sample, seed=11)
        .groupingSets([*sets, []], *keys)
        .agg(F.count(F.lit(1)).alias("rows"), F.grouping_id().alias("set"))
        .orderBy(F.desc("rows"), F.desc("set"), *keys)
        .limit((math.ceil(1 / share) + 1) * len(keys) + 1)
        .collect()
    )
    total = next((row["rows"] for row in heaviest if row["set"] == everything), 0)
    least = max(2, share * total)
    found: dict[str, dict] = {}
    for position, key in enumerate(keys):
        own = everything - 2 ** (len(keys) - 1 - position)
        found[key] = {
            row[key]: row["rows"] / total
            for row in heaviest
            if row["set"] == own and row[key] is not None and row["rows"] >= least
        }
    return found


def hot_in_tables(tables: Mapping[str, DataFrame]) -> dict[str, dict]:
    """Hot values of each key column in the table given for it; one job per different table."""
    found: dict[str, dict] = {}
    for table in {id(df): df for df in tables.values()}.values():
        found |= hot_keys(table, [key for key, df in tables.items() if df is table])
    return found


def salted_join(
    left: DataFrame, lookup: DataFrame, on: str, how: str = "left", hot: Mapping | None = None
) -> DataFrame:
    """Shuffled join that spreads the rows of hot keys, and of null keys, over many tasks.

    The lookup rows of a hot key are repeated once per salt value. A hot key gets as many salts
    as the largest share is of the shuffle partitions, so the copies stay bounded by hot keys
    times partitions. The salt depends on the row and on its input partition: it is the same
    when a lost task is run again, and identical rows still spread.
    """
    if how not in KINDS:
        raise ValueError(f"salted_join does not support {how!r}")
    hot = hot or {}
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = salts_for(hot, partitions)
    is_hot = F.col(on).isin(list(hot)) if hot else F.lit(False)
    return (
        left.withColumn(SALT, line_salt(left.columns, on, is_hot, salts, partitions))
        .join(lookup.withColumn(SALT, F.explode(lookup_salts(is_hot, salts))), [on, SALT], how)
        .drop(SALT)
    )


def salts_for(hot: Mapping, partitions: int) -> int:
    """Salts of a hot key: as many as the largest share is of the partitions, two at least."""
    return max(2, math.ceil(max(hot.values(), default=0.0) * partitions))


def line_salt(columns: Sequence[str], on: str, is_hot: Column, salts: int, partitions: int) -> Column:
    """The salt of a row of the large side; 0 unless its key is hot or null."""
    spread_over = F.lit(max(salts, partitions))
    row_hash = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), spread_over)
    spread = ((row_hash + F.spark_partition_id()) % spread_over).cast("int")
    # A null key never finds a match, so its rows may go anywhere.
    return F.when(F.col(on).isNull(), -1 - spread).when(is_hot, spread % salts).otherwise(0)


def lookup_salts(is_hot: Column, salts: int) -> Column:
    """The salts under which a row of the lookup side is found."""
    return F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))


def orphans(
    df: DataFrame, parent: DataFrame, key: str, hot: Mapping | None = None
) -> DataFrame:
    """Rows of `df` whose key is missing from `parent`; a null key counts as missing."""
    return attach(df, parent.select(key), key, "left_anti", hot=hot)


def orphan_count(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row `(failing, total)`: rows without a parent, and all rows.

    Rows are counted per key first, so a key that holds a third of all rows reaches the join
    as one row per map task.
    """
    keys = parent.select(key).distinct().withColumn("_known", F.lit(True))
    known = F.broadcast(keys) if fits_broadcast(keys) else keys
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.join(known, key, "left").agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("rows"))), F.lit(0)).alias("failing"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
    )
