"""Calendar expressions."""

from pyspark.sql import functions as F


def month_start(day):
    return F.trunc(day, "MM")


def first_month_start_from(day):
    """The first day of the month that is not before the given day."""
    return F.when(F.dayofmonth(day) == 1, day).otherwise(
        F.add_months(F.trunc(day, "MM"), 1)
    )


def is_weekend(day):
    return F.weekday(day) >= 5


def calendar_columns(day):
    """The columns of the date dimension."""
    return [
        day.alias("date_key"),
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.month(day).cast("long").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
    ]
