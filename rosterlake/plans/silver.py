"""Silver: clean strings and keep the latest version. No business rule, no filter."""

from pyspark.sql import functions as F

from rosterlake.functions.text import title_case, trim_all
from rosterlake.operators.keys import latest_version

# Order of the tie-break between versions loaded at the same instant. The columns
# gold does not read come last, so leaving them out cannot change its choice.
TIMESHEET_COLUMNS = [
    "timesheet_id", "emp_id", "project_id", "work_date", "fx_month", "hours_worked",
    "is_billable", "hourly_rate_usd", "revenue_usd", "allocation_pct", "is_anomaly",
    "is_weekend_work", "is_correction", "entry_type", "load_timestamp", "batch_id",
    "created_at", "original_timesheet_id",
]


def silver_employees(employees):
    return employees.select(
        "emp_id",
        trim_all(title_case(F.col("name"))).alias("full_name"),
        F.coalesce("department", F.lit("Unassigned")).alias("department"),
        title_case(trim_all(F.col("designation"))).alias("designation_level"),
        "local_salary",
        "currency",
        title_case(trim_all(F.col("region"))).alias("region"),
        "join_date",
    )


def silver_projects(projects):
    return projects.select(
        "project_id",
        trim_all(F.col("project_name")).alias("project_name"),
        trim_all(F.col("client_name")).alias("client_name"),
        "client_country",
    )


def silver_timesheets(timesheets, columns=None, prune_key=None):
    """The latest version of each timesheet.

    columns: keep only these. Ties are broken by the columns up to the last one
    kept, so a narrow read picks the same version as a full one.
    prune_key: for callers who vouch that all versions of a timesheet share that
    column, e.g. work_date; filters on it then reach the partitions.
    """
    kept = list(columns or timesheets.columns)
    key = ["timesheet_id"] + ([prune_key] if prune_key else [])
    known = ["batch_id"] + [c for c in TIMESHEET_COLUMNS if c != "batch_id"]
    ranked = known + [c for c in timesheets.columns if c not in known]
    ranked = [c for c in ranked if c not in ("load_timestamp", *key)]
    last = max([i for i, c in enumerate(ranked) if c in kept], default=-1)
    ties = ranked[: last + 1]
    order = [F.desc("load_timestamp")] + [F.desc(c) for c in ties]
    used = timesheets.select(*dict.fromkeys([*key, "load_timestamp", *ties, *kept]))
    return latest_version(used, key, order).select(*kept)


def silver_exchange_rates(rates):
    return rates.select("fx_month", "base_currency", "currency_code", "rate_to_usd")
