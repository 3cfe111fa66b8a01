"""Rank over all rows without a task that sees all of them."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import work_dir


def rank_all(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """`df` with the rank of its rows by `value`, the greatest first; ties share a rank, nulls come last.

    Rows are counted per value first, so ties are one row whatever their number. The values are dealt by
    ranges and written with the task they fell to; the rank is then the rows of earlier tasks, of which a
    row per task reaches the driver, plus those before it in its own task.
    """
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    dealt = counted.repartitionByRange(F.desc_nulls_last(value)).withColumn("_task", F.spark_partition_id())
    path = work_dir(df.sparkSession, "ranges")
    dealt.write.parquet(path)
    ranges = df.sparkSession.read.schema(dealt.schema).parquet(path)
    tasks = sorted(tuple(r) for r in ranges.groupBy("_task").agg(F.sum("_rows")).collect())
    before = accumulate((rows for _, rows in tasks), initial=0)
    starts = df.sparkSession.createDataFrame(
        [(task, start) for (task, _), start in zip(tasks, before)], "_task int, _start long"
    )
    earlier = Window.partitionBy("_task").orderBy(F.desc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = ranges.join(F.broadcast(starts), "_task").select(
        F.col(value).alias("_value"), (F.col("_start") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1).alias(out)
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).select(*df.columns, out)
