"""Data-quality profiles of the bronze tables: one aggregate each."""

from pyspark.sql import functions as F

from rosterlake.constants import BENCH_PROJECT_ID, MARKET_SHARE_BASE
from rosterlake.functions.numbers import exact_avg, money_sum, percent, round_half_up


def _rows():
    return F.count(F.lit(1))


def with_share(groups, count, grouped, digits):
    """Share of each group in all rows of the grouped frame.

    The total is a scalar subquery that counts the rows, which Parquet answers from
    its footers. A window over all groups would gather them in one task, however
    many there are.
    """
    total = grouped.agg(_rows()).scalar()
    return groups.withColumn("pct", round_half_up(percent(F.col(count), total), digits))


def preview(frame, *order, rows=10):
    """The first rows in a stated order."""
    return frame.orderBy(*order).limit(rows)


def date_range(timesheets):
    first, last = F.min("work_date"), F.max("work_date")
    return timesheets.agg(
        first.alias("start_date"),
        last.alias("end_date"),
        F.datediff(last, first).cast("long").alias("total_days"),
    )


def department_nulls(employees):
    """Grouped by the raw column, so that a literal MISSING stays a group of its own."""
    return (
        employees.groupBy("department")
        .agg(_rows().alias("employee_count"))
        .select(F.coalesce("department", F.lit("MISSING")).alias("department"), "employee_count")
        .orderBy(F.desc("employee_count"))
    )


def hours(timesheets):
    h = F.col("hours_worked")
    return timesheets.agg(
        _rows().alias("total_rows"),
        F.count_if(h < 0).alias("negative_count"),
        F.count_if(h == 0).alias("zero_count"),
        F.count_if(h > 0).alias("positive_count"),
        round_half_up(F.min(h), 2).alias("min_hours"),
        round_half_up(F.max(h), 2).alias("max_hours"),
    )


def messy_names(employees, rows=10):
    padded = F.col("name").like(" %") | F.col("name").like("% ")
    return preview(
        employees.filter(padded).select(
            "emp_id", "name", F.length("name").cast("long").alias("name_length")
        ),
        "emp_id",
        rows=rows,
    ).select("name", "name_length")


def regions(employees):
    return employees.groupBy("region").agg(_rows().alias("employee_count")).orderBy("region")


def designations(employees):
    return (
        employees.groupBy("designation")
        .agg(_rows().alias("employee_count"))
        .orderBy(F.desc("employee_count"))
    )


def currencies(employees):
    salary = F.col("local_salary")
    groups = employees.groupBy("currency").agg(
        _rows().alias("employee_count"),
        round_half_up(F.min(salary), 2).alias("min_salary"),
        round_half_up(F.max(salary), 2).alias("max_salary"),
        round_half_up(exact_avg(salary), 2).alias("avg_salary"),
    )
    return with_share(groups, "employee_count", employees, 1).orderBy(F.desc("employee_count"))


def exchange_rates(rates):
    rate = F.col("rate_to_usd")
    return (
        rates.groupBy("currency_code", "base_currency")
        .agg(
            _rows().alias("monthly_snapshots"),
            F.min("fx_month").alias("earliest"),
            F.max("fx_month").alias("latest"),
            round_half_up(F.min(rate), 6).alias("min_rate"),
            round_half_up(F.max(rate), 6).alias("max_rate"),
        )
        .orderBy("currency_code")
    )


def markets(projects, base=MARKET_SHARE_BASE):
    """Client projects by market, as a share of a stated number of projects.

    base=None takes the counted number instead.
    """
    clients = projects.filter(F.col("project_id") != BENCH_PROJECT_ID)
    groups = clients.groupBy("client_country").agg(_rows().alias("project_count"))
    if base is None:
        shared = with_share(groups, "project_count", clients, 1)
    else:
        shared = groups.withColumn(
            "pct", round_half_up(percent(F.col("project_count"), F.lit(base)), 1)
        )
    return shared.orderBy(F.desc("project_count"))


def bench_row(projects):
    return projects.filter(F.col("project_id") == BENCH_PROJECT_ID).select(
        "project_id", "project_name", "client_name", "client_country"
    )


def entry_types(timesheets):
    groups = timesheets.groupBy("entry_type", "is_correction").agg(
        _rows().alias("row_count"),
        money_sum(F.col("revenue_usd")).alias("total_revenue_usd"),
        round_half_up(exact_avg(F.col("hours_worked")), 2).alias("avg_hours"),
    )
    return with_share(groups, "row_count", timesheets, 2).orderBy("entry_type")


def id_uniqueness(timesheets):
    distinct = F.count_distinct("timesheet_id")
    return timesheets.agg(
        _rows().alias("total_rows"),
        distinct.alias("unique_ids"),
        (_rows() - distinct).alias("duplicate_count"),
    )


def batches(timesheets, rows=10):
    """The latest loads, for tracing."""
    return preview(
        timesheets.groupBy("batch_id").agg(
            _rows().alias("rows_in_batch"),
            F.min("load_timestamp").alias("batch_start"),
            F.max("load_timestamp").alias("batch_end"),
            F.min("work_date").alias("work_date_from"),
            F.max("work_date").alias("work_date_to"),
        ),
        F.desc("batch_start"),
        "batch_id",
        rows=rows,
    )


def daily_id_sketches(timesheets, size=14):
    """One mergeable sketch of the ids of each day, of 2**size registers: some kilobytes at most, however many rows a day has.

    Kept as a table and appended to by day, it answers how many distinct ids any range of days has
    without the fact; the standard error is about 1.04 / sqrt(2**size), 0.8 % by default.
    """
    return timesheets.groupBy("work_date").agg(
        F.hll_sketch_agg("timesheet_id", F.lit(size)).alias("id_sketch"), F.count(F.lit(1)).alias("row_count"))


def distinct_ids(sketch):
    """The estimate over a group of sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))
