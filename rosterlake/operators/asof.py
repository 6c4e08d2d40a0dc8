"""Interval lookup: the latest interval started on or before a day decides."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rosterlake.constants import BENCH_PROJECT_ID


def active_project(probes, schedule, key="emp_id", day="work_date", default=BENCH_PROJECT_ID,
                   days_unique=False):
    """Add the project of the interval with the greatest start <= day, if day <= its end.

    An older interval that still covers the day is not used; no interval gives the
    default. Both sides are first reduced to one row per key and day, so one key
    never brings more rows to a task than there are days in the calendar, however
    many probes or intervals it has; the answer then joins back by equality.

    days_unique: the caller vouches for one probe per key and day, which saves the
    reduction and the join back.
    """
    interval = F.struct("end_date", "project_id")
    starts = (
        schedule.groupBy(F.col(key), F.col("start_date").alias(day))
        .agg(F.max(interval).alias("_interval"))
        .withColumn("_is_probe", F.lit(False))
    )
    asked = probes if days_unique else probes.select(key, day).distinct()
    # the interval rows of a day sort before its probe
    so_far = (
        Window.partitionBy(key)
        .orderBy(day, "_is_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        asked.withColumn("_is_probe", F.lit(True))
        .unionByName(starts, allowMissingColumns=True)
        .withColumn("_latest", F.last("_interval", ignorenulls=True).over(so_far))
        .filter("_is_probe")
        .withColumn(
            "project_id",
            F.coalesce(
                F.when(F.col(day) <= F.col("_latest.end_date"), F.col("_latest.project_id")),
                F.lit(default).cast("long"),
            ),
        )
        .drop("_is_probe", "_interval", "_latest")
    )
    if days_unique:
        return answers
    # a probe without a key or day finds no answer, and has no interval either
    return probes.join(answers, [key, day], "left").withColumn(
        "project_id", F.coalesce("project_id", F.lit(default).cast("long"))
    )
