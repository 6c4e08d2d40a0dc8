"""The date dimension and series of days and months."""

from pyspark.sql import functions as F

from rosterlake.functions.dates import calendar_columns, first_month_start_from


def series(bounds, first, last, months=False, name="day"):
    """One row per day, or per month start, from first to last, both included.

    Rows whose first day lies after the last yield nothing. `sequence` alone would
    count downwards, or fail when Spark evaluates constant bounds ahead of the filter.
    """
    if months:
        first = first_month_start_from(first)
        step = F.expr("INTERVAL 1 MONTH")
    else:
        step = F.expr("INTERVAL 1 DAY")
    return (
        bounds.withColumn("_first", first)
        .withColumn("_last", last)
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn(name, F.explode(F.sequence("_first", F.greatest("_first", "_last"), step)))
        .drop("_first", "_last")
    )


def dim_date(bounds):
    """Calendar between two dates.

    bounds: a one-row frame with the columns first_day and last_day, so that the
    range may come from data without a round trip through the driver.
    """
    days = series(bounds, F.col("first_day"), F.col("last_day"), name="date_key")
    return days.select(*calendar_columns(F.col("date_key")))


def date_bounds(spark, first, last):
    """The one-row frame of a range stated as dates."""
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )
