"""The six silver and gold views as SQL text in the catalog, readable in every session.

A view of the catalog may not refer to a temporary one or to a DataFrame, so the text states what
plans.silver and plans.gold build from columns; the tests hold one against the other.
"""

from rosterlake.constants import COST_DAYS_PER_MONTH, COST_HOURS_PER_DAY
from rosterlake.functions.text import WHITE_SPACE, WORD_START
from rosterlake.plans.silver import TIMESHEET_COLUMNS


def _trim(column):
    signs = "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE)
    return f"btrim({column}, '{signs}')"


def _title(column):
    words = f"split(lower({column}), r'{WORD_START}')"
    return f"array_join(transform({words}, w -> concat(upper(left(w, 1)), substr(w, 2))), '')"


def _round(value, digits):
    return f"coalesce(CAST(round(try_cast({value} AS DECIMAL(28,10)), {digits}) AS DOUBLE), {value})"


def _versions(prune_key):
    key = ["timesheet_id"] + ([prune_key] if prune_key else [])
    ties = ["batch_id"] + [c for c in TIMESHEET_COLUMNS if c != "batch_id"]
    ties = [c for c in ties if c not in ("load_timestamp", *key)]
    return ", ".join(key), ", ".join(f"{c} DESC" for c in ["load_timestamp", *ties])


def view_texts(database, prune_key=None):
    """Name and text of each view, silver before the gold that reads it."""
    key, newest_first = _versions(prune_key)
    salary = "local_salary * rate_to_usd"
    bench = f"{salary} / {float(COST_DAYS_PER_MONTH)!r}D / {float(COST_HOURS_PER_DAY)!r}D * hours_worked"
    return {
        "silver_employees": f"""
            SELECT emp_id, {_trim(_title('name'))} AS full_name, coalesce(department, 'Unassigned') AS department,
                   {_title(_trim('designation'))} AS designation_level, local_salary, currency,
                   {_title(_trim('region'))} AS region, join_date
            FROM {database}.dim_employees""",
        "silver_projects": f"""
            SELECT project_id, {_trim('project_name')} AS project_name, {_trim('client_name')} AS client_name,
                   client_country
            FROM {database}.dim_projects""",
        "silver_timesheets": f"""
            SELECT {", ".join(TIMESHEET_COLUMNS)}
            FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {newest_first}) AS row_num
                  FROM {database}.fact_timesheets)
            WHERE row_num = 1""",
        "silver_exchange_rates": f"""
            SELECT fx_month, base_currency, currency_code, rate_to_usd FROM {database}.dim_exchange_rates""",
        "gold_employees": f"""
            SELECT emp_id, full_name, department, designation_level, local_salary, currency, region, join_date,
                   {_round(salary, 2)} AS salary_usd
            FROM {database}.silver_employees
            LEFT JOIN (SELECT currency_code, rate_to_usd FROM {database}.silver_exchange_rates
                       WHERE fx_month = (SELECT max(fx_month) FROM {database}.silver_exchange_rates))
            ON currency = currency_code""",
        "gold_timesheets_enriched": f"""
            SELECT timesheet_id, t.emp_id, t.project_id, work_date, t.fx_month, full_name, department,
                   designation_level, region, currency, local_salary, {_round(salary, 2)} AS salary_usd,
                   project_name, client_country, hours_worked, is_billable, hourly_rate_usd, revenue_usd,
                   allocation_pct,
                   CASE WHEN is_billable = FALSE THEN {_round(bench, 2)} ELSE 0D END AS bench_cost_usd,
                   is_anomaly, is_weekend_work, entry_type, batch_id
            FROM {database}.silver_timesheets t
            JOIN {database}.silver_employees e ON t.emp_id = e.emp_id
            JOIN {database}.silver_projects p ON t.project_id = p.project_id
            JOIN {database}.silver_exchange_rates r ON e.currency = r.currency_code AND t.fx_month = r.fx_month
            WHERE hours_worked <> 0 AND is_correction = FALSE""",
    }


def store_views(lake, prune_key=None):
    """Create or replace the six views in the lake's database; absent tables are created empty.

    prune_key: as in silver_timesheets; "work_date" for a fact made by the load.
    """
    for table in ("dim_employees", "dim_projects", "dim_exchange_rates", "fact_timesheets"):
        lake.create(table)
    texts = view_texts(lake.database, prune_key)
    for name, text in texts.items():
        lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.name(name)} AS {text}")
    return list(texts)
