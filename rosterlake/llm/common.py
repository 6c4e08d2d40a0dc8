"""What the text operators share: tables, stored intermediate results, words."""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from rosterlake.session import task_count, work_folder

WORD = r"[\p{L}\p{N}]+"
# Spark's setting that removes a statement's shuffle files at its end; otherwise they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows that Spark hands to a Python task at once. A task holds them as Arrow and as Python objects, beside what it makes of them.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _settings(spark, settings):
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _written(spark, batch):
    return _settings(spark, {CLEANUP: "true", **({BATCH: batch} if batch else {})})


def stored(frame, folder=None, batch=None):
    """Write to the shared work folder and read back, so that lost executors cost no recomputation.

    The result is stored, so the shuffle files behind it are not needed again and go at once. `batch` is the number of rows
    that Python gets at once.
    """
    spark = frame.sparkSession
    path = f"{folder or work_folder(spark)}/{uuid.uuid4().hex}"
    with _written(spark, batch):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def clustered(frame, key, folder, batch=None):
    """Like stored, in buckets of the key: a join by the key reads them as they are, without a shuffle of these rows.

    Buckets need a table in the catalog; it is there inside the `with` only.
    """
    spark = frame.sparkSession
    name, buckets = f"rosterlake_{uuid.uuid4().hex}", task_count(spark)
    place = f"spark_catalog.default.{name}"
    try:
        with _written(spark, batch):
            # The shuffle deals rows as the buckets do, so that a bucket is one file.
            frame.repartition(buckets, key).write.bucketBy(buckets, key).option("path", f"{folder}/{name}").saveAsTable(place)
        yield spark.table(place)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {place}")


def discarded(spark, folder):
    """Remove a work folder that no frame in use reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text):
    """Lower-case words of a text; null counts as empty."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
