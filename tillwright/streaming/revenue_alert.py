"""The daily revenue alert over a stream of purchases.

Start it from a :func:`stream_session`, which fixes the time zone that days are cut in and the
number of state partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.plans.alerts import days_below
from tillwright.schemas import MONEY


def stream_session(spark: SparkSession, partitions: int = 32) -> SparkSession:
    """A session of the same application for the stream: days are UTC days, and the state, a row
    per open day, has few partitions however many the batch jobs shuffle into."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet files below `path` (a folder or a pattern) as a stream of rows.

    All files present form one batch, so the order they are read in makes no row late.
    """
    return spark.readStream.schema(schema).parquet(path)


def daily_revenue(events: DataFrame, lateness: str = "1 day", once_by: str | None = None) -> DataFrame:
    """Revenue per day from `(ts, amount)` rows; a day closes once the watermark has passed it.

    With `once_by`, rows that repeat that id within the lateness count once, so that a file delivered twice
    does not raise the revenue of a day. The state then holds the ids of that stretch; rows without an id
    are one and the same.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    if once_by:
        timed = timed.dropDuplicatesWithinWatermark([once_by])
    return (
        timed.groupBy(F.window("ts", "1 day").alias("day"))
        .agg(F.sum("amount").cast("double").alias("total_revenue"))
        .select(F.col("day.start").cast("date").alias("full_date"), "total_revenue")
    )


def purchases(events: DataFrame, *more: str) -> DataFrame:
    return events.where(F.col("event_type") == "purchase").select(
        "ts", F.col("value").cast(MONEY).alias("amount"), *more
    )


def start_alert(
    events: DataFrame, target: float, out: str, checkpoint: str, lateness: str = "1 day",
    once_by: str | None = None,
) -> StreamingQuery:
    """Writes a row for each closed day below `target`; picks up where its checkpoint left off.

    `once_by` names the id of an event; events delivered again then count once (:func:`daily_revenue`).
    """
    sales = purchases(events, once_by) if once_by else purchases(events)
    return (
        days_below(daily_revenue(sales, lateness, once_by), target)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
