"""Small helpers the operators share."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.session import work_dir


def whole(column: str | Column) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def written(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """`df` as a table in the shared work folder: cuts the lineage and outlives any executor."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shipped(spark: SparkSession, thing) -> Broadcast:
    """Sends an object of bounded size to the tasks, its class included."""
    return spark.sparkContext.broadcast({"code": cloudpickle.dumps(thing)})


def arrived(sent: Broadcast):
    """The object in a task; tasks of one worker process share it."""
    held = sent.value
    if "thing" not in held:
        held["thing"] = cloudpickle.loads(held["code"])
    return held["thing"]
