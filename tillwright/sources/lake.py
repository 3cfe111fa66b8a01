"""Tables of the session catalog."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Jobs side by side; each holds its plans in the driver's memory.
AT_ONCE = 5
#: Formats whose large tables are compressed by zstd, about a third smaller here than by their default. Others keep
#: it, since the limit of broadcasts goes by the size of files, and smaller ones would let through more rows.
ZSTD_FORMATS = ("parquet", "orc")


def _parts(df: DataFrame | Sequence[DataFrame]) -> Sequence[DataFrame]:
    return [df] if isinstance(df, DataFrame) else df


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


@dataclass(frozen=True)
class Lake:
    """Where a pipeline keeps its tables.

    `root` gives each table its own folder below a shared location; without it the catalog's
    warehouse is used. `fmt` is any table format the session knows ("parquet", "orc", "delta").
    """

    spark: SparkSession
    database: str = "default"
    root: str | None = None
    fmt: str = "parquet"

    def create(self) -> None:
        location = f" LOCATION '{self.root}'" if self.root else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{location}")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def side_by_side(self, jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
        """Runs jobs that do not depend on each other at the same time, `AT_ONCE` of them, so that the cluster
        is not left to one small table; returns what each gave. Any failure is raised."""
        if not jobs:
            return {}
        in_session = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(max_workers=min(AT_ONCE, len(jobs))) as pool:
            running = {name: pool.submit(in_session(job)) for name, job in jobs.items()}
            return {name: job.result() for name, job in running.items()}

    def replace_partition(self, df: DataFrame | Sequence[DataFrame], table: str, column: str, value) -> int:
        """Puts the rows of `df`, all with `value` in `column`, in place of that partition; several frames
        one after the other.

        Other partitions stay, so a repeated load of one batch leaves the table as the first did. Rows are
        written as they lie: a task writes one file, as there is one partition.
        """
        if not self.spark.catalog.tableExists(self.name(table)):
            return self.write(df, table, partition_by=[column], spread=False)
        columns, written = [c for c in self.read(table).columns if c != column], 0
        for number, part in enumerate(_parts(df)):
            counted = Observation()
            rows = part.select(*columns).observe(counted, F.count(F.lit(1)).alias("rows"))
            self.spark.sql(
                f"INSERT {'INTO' if number else 'OVERWRITE'} {self.name(table)} PARTITION ({column} = '{value}') "
                "SELECT * FROM {rows}",
                rows=rows,
            )
            written += counted.get["rows"]
        return written

    def publish(self, df: DataFrame, table: str, grace: float = 24 * 3600) -> int:
        """Replaces a table without a moment in which a reader finds less or a mix; returns its rows.

        Every version is a folder of its own, and the catalog's entry is turned to it once it is complete.
        Readers that were at it go on with the version they opened: it stays for `grace` seconds after another
        took its place, and a later publish removes it. So `grace` is to be longer than any reader runs. A
        version with other columns takes a new entry in place of the old one, which is the one case with a
        gap. Needs `root`; the table is not partitioned.
        """
        if not self.root:
            raise ValueError("publish needs a lake with a root")
        top, version = f"{self.root.rstrip('/')}/{table}-versions", f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(self.fmt).save(f"{top}/{version}")
        rows = counted.get["rows"]
        name, place = self.name(table), f"{top}/{version}"
        exists = self.spark.catalog.tableExists(name)
        if exists and _shape(self.spark.table(name)) == _shape(df):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.catalog.createTable(name, path=place, source=self.fmt, schema=df.schema)
        self._drop_versions(top, grace)
        return rows

    def _drop_versions(self, top: str, grace: float) -> None:
        """Removes versions that another replaced more than `grace` seconds ago; their names begin with their time."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(top)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        versions = sorted((status.getPath() for status in files.listStatus(folder)), key=lambda p: p.getName())
        for old, following in zip(versions, versions[1:]):
            if int(following.getName().split("-")[0]) <= time.time_ns() - grace * 1e9:
                files.delete(old, True)

    def write(
        self,
        df: DataFrame | Sequence[DataFrame],
        table: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        buckets: int = 0,
        bucket_by: Sequence[str] = (),
        spread: bool = True,
        dense: bool = False,
    ) -> int:
        """Writes the table and returns how many rows went in, counted during the write.

        With `partition_by`, rows are first rebalanced on those columns: adaptive execution then
        splits a partition value that holds most rows and merges small ones, so the number of
        files follows the data and not tasks times values. That shuffles all rows; without `spread` they are
        written as they lie, which suits a few values of the partition columns. Partitioned tables, whose size no plan
        knows, and with `dense` others that nobody broadcasts, are compressed by zstd. With `buckets` and `bucket_by`, rows are dealt
        into that many buckets first, so each bucket is one file of its partition.

        Several frames are written one after the other: the first by `mode`, the others are added to it.
        """
        how = (partition_by, buckets, bucket_by, spread, dense)
        return sum(self._write(part, table, "append" if i else mode, *how) for i, part in enumerate(_parts(df)))

    def _write(
        self, df: DataFrame, table: str, mode: str, partition_by: Sequence[str], buckets: int,
        bucket_by: Sequence[str], spread: bool, dense: bool,
    ) -> int:
        counted = Observation()
        rows = df
        if buckets:
            rows = df.repartition(buckets, *bucket_by)
        elif partition_by and spread:
            rows = df.hint("rebalance", *partition_by)
        writer = (
            rows.observe(counted, F.count(F.lit(1)).alias("rows"))
            .write.format(self.fmt)
            .mode(mode)
        )
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if buckets:
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        if self.fmt in ZSTD_FORMATS and (partition_by or dense):
            # Version 2 stores numbers of a file as differences: a twelfth less, in no more time.
            writer = writer.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
        if self.root:
            writer = writer.option("path", f"{self.root.rstrip('/')}/{table}")
        if mode == "overwrite" and self.fmt == "delta":
            writer = writer.option("overwriteSchema", "true")
        writer.saveAsTable(self.name(table))
        return counted.get["rows"]
