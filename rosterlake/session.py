"""Session defaults and the shared work folder."""

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_folder = None
# Spark's setting that removes a statement's shuffle files at its end; otherwise they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What Parquet files of rows with hashed ids are written with: half the size of the default.
COMPRESSION = "zstd"


def build_session(app="rosterlake", **options):
    """A session with the settings the jobs are designed for.

    Partition counts stay with adaptive execution: it coalesces small shuffle
    partitions, splits skewed join partitions and turns a sort-merge join into a
    broadcast join only once the measured side is below the threshold.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **options,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def task_count(spark):
    """As many tasks as the session shuffles into, and no fewer than it has cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


@contextmanager
def session_setting(spark, key, value):
    """A session setting for the length of a statement or more; None leaves it as it is."""
    if value is None:
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def tidy(spark):
    """Statements inside leave no shuffle files behind; no frame made inside may be run twice."""
    return session_setting(spark, CLEANUP, "true")


def discard(spark, folder):
    """Remove a work folder that no frame in use reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def work_folder(spark):
    """A new folder below the shared one the cluster names in spark.checkpoint.dir.

    Only a local session may go without that setting; a cluster's executors could
    not see a temporary folder of the driver.
    """
    global _local_folder
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_folder is None:
            _local_folder = tempfile.mkdtemp(prefix="rosterlake-")
            atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
        base = _local_folder
    return f"{base.rstrip('/')}/rosterlake-{uuid.uuid4().hex}"
