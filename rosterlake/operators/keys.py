"""Keys: latest version, duplicates, derived ids, missing keys."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def latest_version(frame, key, order):
    """One row per key, the first in the given order.

    Spark plans the filter on the row number as a group limit before the shuffle:
    a task sends at most one row per key, however many copies one key has.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return (
        frame.withColumn("row_num", F.row_number().over(window))
        .filter(F.col("row_num") == 1)
        .drop("row_num")
    )


def duplicate_keys(frame, key):
    """Keys held by two rows or more, with their row count; combined map-side."""
    return (
        frame.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def duplicate_members(frame, key):
    """Every row whose key occurs twice or more.

    A semi-join on the counted keys instead of a window over each key, which would
    hold all copies of one key in one task.
    """
    counted = duplicate_keys(frame, key).select(*[F.col(k).alias(f"_{k}") for k in key])
    # null keys are equal to each other here, as they are in the count
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return frame.join(counted, same, "left_semi")


def row_id(*columns):
    """A 256-bit id of the key: the same row keeps its id when a task is retried."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)


def stored_on_days(rows, table, columns):
    """The table's rows, of the given columns, on the days that occur among rows.

    The distinct days, no more than a calendar has, are broadcast and prune the table's
    partitions at run time, so that one late row does not open all the days since. Spark
    prunes only by a side with a filter, which the lower bound is.
    """
    days = rows.select("work_date").filter(F.col("work_date") >= F.lit("0001-01-01").cast("date")).distinct()
    return table.select(*dict.fromkeys(["work_date", *columns])).join(F.broadcast(days), "work_date", "left_semi")


def fingerprint(*columns):
    """A 64-bit hash of what a row says; nulls count by their place."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])


def missing_keys(candidates, existing, key):
    """One candidate per key that the existing table does not hold."""
    known = existing.select(*key).distinct()
    return candidates.dropDuplicates(key).join(known, key, "left_anti")
