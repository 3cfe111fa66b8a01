"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings every job of this package is designed for.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange: a customer
    # join directly under a per-customer aggregate would otherwise keep its hot task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: With it the shuffle files of a query go when the query ends. Else they stay until the driver happens to collect
#: its garbage, and a job of many steps holds those of all its steps.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_work_dirs: dict[str, str] = {}
_made: dict[str, tuple[SparkSession, list[str]]] = {}


def build_session(app: str = "tillwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """While it is open, each query of the session removes its own shuffle files; then the setting is as before."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(TIDY)
        else:
            spark.conf.set(TIDY, before)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or folder of the shared store, if it is there."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a temporary folder of this
    machine; a cluster session without it is an error, since its executors could not all
    see such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_work_dirs.get(context.applicationId)
        if base is None:
            base = tempfile.mkdtemp(prefix="tillwright-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
            _local_work_dirs[context.applicationId] = base
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    application = spark.sparkContext.applicationId
    if application not in _made:
        _made[application] = (spark, [])
        atexit.register(clear_work, application)
    _made[application][1].append(path)
    return path


def clear_work(application: str) -> None:
    """Drops the databases over, and removes, the work folders that an application was given.

    Runs at the end of the process, or earlier by hand.
    """
    spark, paths = _made.pop(application, (None, []))
    context = None if spark is None else spark.sparkContext
    if context is None or context._jsc is None or context._jsc.sc().isStopped():
        # Without a session only folders that this machine sees can be removed.
        for path in paths:
            shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
        return
    for database in spark.catalog.listDatabases():
        if any(database.locationUri.rstrip("/").endswith(path.split("://")[-1].rstrip("/")) for path in paths):
            spark.sql(f"DROP DATABASE IF EXISTS {database.name} CASCADE")
    for path in paths:
        remove(spark, path)


def sizing(
    input_bytes: int, cores: int, task_bytes: int = 256 * 2**20, split_bytes: int = 128 * 2**20
) -> dict[str, str]:
    """Partition settings for a job that reads `input_bytes` on `cores` cores.

    About `task_bytes` of shuffle data per task at any size, and at least two tasks per core so that
    none idles; scans read `split_bytes` per task. Larger values mean fewer tasks for the
    driver to track. Adaptive execution merges what turns out small.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(2 * cores, -(-input_bytes // task_bytes))),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }
