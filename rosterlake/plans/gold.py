"""Gold: price salaries, revenue and bench cost in USD. Reads silver only.

No join carries a broadcast hint: Spark broadcasts a dimension when its measured
size is below the threshold and otherwise sort-merges, splitting skewed keys such
as the bench project.
"""

from pyspark.sql import functions as F

from rosterlake.constants import COST_DAYS_PER_MONTH, COST_HOURS_PER_DAY
from rosterlake.functions.numbers import money_sum, round_half_up
from rosterlake.plans import silver

FACT_COLUMNS = [
    c for c in silver.TIMESHEET_COLUMNS if c not in ("created_at", "original_timesheet_id")
]


def gold_employees(employees, rates):
    """Salaries in USD at the latest month of the table, null where it lacks the currency."""
    latest = rates.filter(
        F.col("fx_month") == rates.select(F.max("fx_month")).scalar()
    ).select(F.col("currency_code").alias("currency"), "rate_to_usd")
    return employees.join(latest, "currency", "left").select(
        "emp_id", "full_name", "department", "designation_level", "local_salary",
        "currency", "region", "join_date",
        round_half_up(F.col("local_salary") * F.col("rate_to_usd"), 2).alias("salary_usd"),
    )


def gold_timesheets_enriched(timesheets, employees, projects, rates,
                             days_per_month=COST_DAYS_PER_MONTH,
                             hours_per_day=COST_HOURS_PER_DAY):
    """One row per worked original entry, at the rate of its own month."""
    worked = timesheets.filter(
        (F.col("hours_worked") != 0) & (F.col("is_correction") == F.lit(False))
    )
    month_rates = rates.select(
        "fx_month", F.col("currency_code").alias("currency"), "rate_to_usd"
    )
    priced = (
        worked.join(employees, "emp_id")
        .join(projects.select("project_id", "project_name", "client_country"), "project_id")
        .join(month_rates, ["currency", "fx_month"])
    )
    salary = F.col("local_salary") * F.col("rate_to_usd")
    bench_cost = salary / F.lit(days_per_month) / F.lit(hours_per_day) * F.col("hours_worked")
    return priced.select(
        "timesheet_id", "emp_id", "project_id", "work_date", "fx_month",
        "full_name", "department", "designation_level", "region", "currency", "local_salary",
        round_half_up(salary, 2).alias("salary_usd"),
        "project_name", "client_country",
        "hours_worked", "is_billable", "hourly_rate_usd", "revenue_usd", "allocation_pct",
        F.when(F.col("is_billable") == F.lit(False), round_half_up(bench_cost, 2))
        .otherwise(F.lit(0.0)).alias("bench_cost_usd"),
        "is_anomaly", "is_weekend_work", "entry_type", "batch_id",
    )


def gold_from_bronze(timesheets, employees, projects, rates, prune_key=None):
    """The enriched fact straight from bronze, reading only the columns it needs.

    prune_key: as in silver_timesheets; ids made by the load hash the work date, so for
    its fact "work_date" holds, and a day of gold reads a day of the fact.
    """
    return gold_timesheets_enriched(
        silver.silver_timesheets(timesheets, FACT_COLUMNS, prune_key),
        silver.silver_employees(employees),
        silver.silver_projects(projects),
        silver.silver_exchange_rates(rates),
    )


def gold_totals(enriched):
    return enriched.agg(
        money_sum(F.col("revenue_usd")).alias("total_revenue"),
        money_sum(F.col("bench_cost_usd")).alias("total_bench_cost"),
    )
