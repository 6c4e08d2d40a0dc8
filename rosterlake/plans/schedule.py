"""Staffing timelines and working days per employee."""

from pyspark.sql import functions as F

from rosterlake.constants import HISTORY_START
from rosterlake.functions.dates import is_weekend
from rosterlake.operators.prefix_sum import add_sum_before
from rosterlake.session import task_count


def build_schedule(employees, assignments, horizon, history_start=HISTORY_START):
    """Lay the assignments of each employee end to end from the day they can start.

    employees: emp_id, join_date, project_ids (the cycle of projects, array).
    assignments: emp_id, seq (0, 1, ...), duration_days, gap_days.
    An assignment that starts on the horizon or later is left out, one that
    crosses it ends there.
    """
    length = F.col("duration_days") + F.col("gap_days")
    placed = add_sum_before(
        assignments.withColumn("_length", length), "emp_id", "seq", "_length", "_offset_days"
    )
    end = F.lit(horizon).cast("date")
    begin = F.greatest(F.lit(history_start).cast("date"), F.col("join_date"))
    cycle = F.size("project_ids")
    return (
        placed.join(employees.select("emp_id", "join_date", "project_ids"), "emp_id")
        .filter(F.col("_offset_days") < F.datediff(end, begin))
        .withColumn("start_date", F.date_add(begin, F.col("_offset_days").cast("int")))
        .select(
            "emp_id",
            F.get("project_ids", (F.col("seq") % cycle).cast("int")).cast("long").alias("project_id"),
            "start_date",
            F.least(F.date_add("start_date", F.col("duration_days").cast("int")), end).alias("end_date"),
        )
    )


def employee_days(employees, first, last, absences, weekend_work):
    """The days each employee may log: a dense spine of employees and days.

    From the later of `first` and the join date to `last`; days of absence are left
    out, weekend days are kept only where listed.

    The lists meet the employees as one array of days each, no longer than the
    calendar, and the days are multiplied out last: the spine itself is never
    shuffled. Employees are spread over all tasks before they multiply; hashing two
    columns keeps Spark from taking the join's own partitions, merged by size, for it.
    """
    begin = F.greatest(F.lit(first).cast("date"), F.col("join_date"))
    end = F.lit(last).cast("date")
    hired = employees.select("emp_id", begin.alias("_begin")).filter(F.col("_begin") <= end)
    day_lists = (
        _marks(absences, weekend_work)
        .groupBy("emp_id")
        .agg(
            F.collect_set(F.when(F.col("_absent"), F.col("work_date"))).alias("_away"),
            F.collect_set(F.when(F.col("_listed"), F.col("work_date"))).alias("_extra"),
        )
    )
    nothing = F.array().cast("array<date>")
    spread = hired.join(day_lists, "emp_id", "left").repartition(
        task_count(employees.sparkSession), "emp_id", "_begin"
    )
    weekdays = F.filter(
        F.sequence("_begin", F.greatest("_begin", end), F.expr("INTERVAL 1 DAY")),
        lambda d: ~is_weekend(d),
    )
    extra = F.filter(
        F.coalesce("_extra", nothing), lambda d: (d >= F.col("_begin")) & (d <= end)
    )
    days = F.array_except(F.array_union(weekdays, extra), F.coalesce("_away", nothing))
    return spread.select("emp_id", F.explode(days).alias("work_date"))


def _marks(absences, weekend_work):
    """Employee and day of both lists, told apart by two flags."""
    key = ["emp_id", "work_date"]
    away = absences.select(*key, F.lit(True).alias("_absent"), F.lit(False).alias("_listed"))
    extra = weekend_work.select(*key, F.lit(False).alias("_absent"), F.lit(True).alias("_listed"))
    return away.unionByName(extra)


def judge_days(entries, employees, first, last, absences, weekend_work):
    """The entries dated from first to last, each with the reason why it may not be logged, null for one that may.

    One pass: employees and both lists meet the entries by left joins, so that no entry is lost. The
    lists are first reduced to one row per employee and day, so that one join answers both, with many
    rows per key on its left side only. An employee without a join date has always been there.
    Entries without a day belong to no load.
    """
    key = ["emp_id", "work_date"]
    day = F.col("work_date")
    marks = (
        _marks(absences, weekend_work)
        .groupBy(*key)
        .agg(F.bool_or("_absent").alias("_absent"), F.bool_or("_listed").alias("_listed"))
    )
    staff = employees.select("emp_id", F.col("join_date").alias("_joined"), F.lit(True).alias("_known"))
    dated = entries.filter((day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date")))
    reason = (
        F.when(F.col("_known").isNull(), "unknown employee")
        .when(day < F.col("_joined"), "before joining")
        .when(F.col("_absent"), "absent")
        .when(is_weekend(day) & ~F.coalesce("_listed", F.lit(False)), "weekend not listed")
    )
    return (
        dated.join(staff, "emp_id", "left")
        .join(marks, key, "left")
        .withColumn("reason", reason)
        .drop("_joined", "_known", "_absent", "_listed")
    )


def loggable(entries, employees, first, last, absences, weekend_work):
    """The entries that fall on a day of the spine, without building the spine."""
    judged = judge_days(entries, employees, first, last, absences, weekend_work)
    return judged.filter(F.col("reason").isNull()).drop("reason")
