"""The expected result of each query as SQL for the oracle engine."""

from verification.lens_sql import with_lens

_FACT = """timesheet_id, emp_id, project_id, work_date, fx_month, created_at, hours_worked,
  is_billable, hourly_rate_usd, revenue_usd, allocation_pct, is_anomaly, is_weekend_work,
  is_correction, entry_type, original_timesheet_id, load_timestamp, batch_id"""

_CALENDAR = """
SELECT d AS date_key, CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
       CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name, dayname(d) AS day_of_week,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d
      FROM lineitem)"""

_SCHEDULE = """
SELECT emp_id, project_ids[CAST(seq % len(project_ids) AS INT) + 1] AS project_id, start_date,
       least(start_date + CAST(duration_days AS INT), {horizon}) AS end_date
FROM (SELECT *, greatest({history}, join_date) + CAST(coalesce(sum(duration_days + gap_days) OVER
               (PARTITION BY emp_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT)
               AS start_date
      FROM wf_assignments)
WHERE start_date < {horizon}"""

_HALF_HOURS = "round_even(({x}) * 2e0, 0) / 2e0"

_METRICS = f"""
SELECT emp_id, work_date, project_id, is_billable, allocation_pct, hourly_rate_usd, hours_worked,
       sha256(emp_id || '|' || work_date || '|original') AS timesheet_id
FROM (SELECT emp_id, work_date, coalesce(project_id, -1) AS project_id,
             project_id IS NOT NULL AND is_billable AS is_billable,
             CASE WHEN project_id IS NULL THEN 1e0 ELSE allocation_pct END AS allocation_pct,
             CASE WHEN project_id IS NOT NULL AND is_billable THEN hourly_rate_usd ELSE 0e0 END AS hourly_rate_usd,
             CASE WHEN project_id IS NULL THEN base_hours
                  ELSE {_HALF_HOURS.format(x='base_hours * allocation_pct')} END AS hours_worked
      FROM {{entries}})"""

_REVENUE = "CASE WHEN is_billable THEN r2({h} * hourly_rate_usd, 2) ELSE 0e0 END"

_DELTA = "-" + _HALF_HOURS.format(
    x="greatest(5e-1, least(adjusted_hours, greatest(5e-1, least(4e0, abs(hours_worked)))))"
)


def _profile_share(digits):
    return f"r2(count(*) * 100e0 / sum(count(*)) OVER (), {digits}) AS pct"


def _avg(column):
    return (f"r2(CAST(sum(CAST({column} AS DECIMAL(28,10))) AS DOUBLE) / count({column}), 2)")


def _money(column):
    return f"CAST(round(sum(CAST({column} AS DECIMAL(28,10))), 2) AS DOUBLE)"


ORACLES = {
    "scan_projects": "SELECT * FROM wf_projects",
    "seed_or_reuse_employees": "SELECT * FROM wf_employees",
    "fx_from_json": """
        SELECT event_id, currency_code, r2(1e0 / units, 6) AS rate_to_usd
        FROM (SELECT event_id, currency_code, CAST(json_extract(props, '$.' || currency_code) AS DOUBLE) AS units
              FROM (SELECT event_id, props, unnest(json_keys(props)) AS currency_code FROM events))
        WHERE units <> 0""",
    "fx_existing_keys": "SELECT fx_month, currency_code FROM wf_exchange_rates",
    "load_replace_calendar": _CALENDAR,
    "load_append_fact": "SELECT * FROM wf_timesheets",
    "fact_partitioned_write": """
        SELECT work_date, project_id, count(*) AS row_count, sum(hours_worked) AS hours_worked
        FROM wf_timesheets WHERE work_date >= DATE '1998-07-01' GROUP BY work_date, project_id""",
    "fact_schema_evolve": """
        SELECT timesheet_id, load_timestamp, hours_worked,
               CASE WHEN work_date >= DATE '1998-07-01' THEN created_at END AS created_at,
               CASE WHEN work_date >= DATE '1998-07-01' THEN revenue_usd END AS revenue_usd,
               CASE WHEN work_date >= DATE '1998-07-01' THEN is_anomaly END AS is_anomaly,
               CASE WHEN work_date >= DATE '1998-07-01' THEN is_weekend_work END AS is_weekend_work
        FROM wf_timesheets""",
    "empty_tables": """
        SELECT table_name, CAST(column_count AS BIGINT) AS column_count, CAST(0 AS BIGINT) AS rows_before, rows_after
        FROM (SELECT 'dim_employees_source' AS table_name, 8 AS column_count, count(*) AS rows_after FROM wf_employees
              UNION ALL SELECT 'dim_employees', 8, count(*) FROM wf_employees
              UNION ALL SELECT 'dim_projects_source', 4, count(*) FROM wf_projects
              UNION ALL SELECT 'dim_projects', 4, count(*) FROM wf_projects
              UNION ALL SELECT 'dim_date', 7, date_diff('day', min(l_shipdate), max(l_shipdate)) + 1 FROM lineitem
              UNION ALL SELECT 'dim_exchange_rates', 4, count(*) FROM wf_exchange_rates
              UNION ALL SELECT 'fact_timesheets', 18, 0)""",
    "load_audit": """
        SELECT 'dim_date' AS table_name, date_diff('day', min(l_shipdate), max(l_shipdate)) + 1 AS rows_loaded FROM lineitem
        UNION ALL SELECT 'dim_employees', count(*) FROM wf_employees
        UNION ALL SELECT 'dim_projects', count(*) FROM wf_projects
        UNION ALL SELECT 'dim_exchange_rates', count(*) FROM wf_exchange_rates
        UNION ALL SELECT 'fact_timesheets', count(*) FROM wf_timesheets""",
    "silver_employees": "SELECT * FROM silver_employees",
    "silver_projects": "SELECT * FROM silver_projects",
    "silver_timesheets": "SELECT * FROM silver_timesheets",
    "silver_exchange_rates": "SELECT * FROM wf_exchange_rates",
    "gold_employees": """
        SELECT e.emp_id, e.full_name, e.department, e.designation_level, e.local_salary, e.currency, e.region,
               e.join_date, r2(e.local_salary * fx.rate_to_usd, 2) AS salary_usd
        FROM silver_employees e
        LEFT JOIN wf_exchange_rates fx
          ON e.currency = fx.currency_code AND fx.fx_month = (SELECT max(fx_month) FROM wf_exchange_rates)""",
    "gold_timesheets_enriched": "SELECT * FROM gold_timesheets",
    "gold_bucketed": "SELECT * FROM gold_timesheets",
    "gold_from_views": "SELECT * FROM gold_timesheets",
    "gold_totals": f"""
        SELECT {_money('revenue_usd')} AS total_revenue, {_money('bench_cost_usd')} AS total_bench_cost
        FROM gold_timesheets""",
    "preview": "SELECT * FROM wf_timesheets ORDER BY timesheet_id, load_timestamp LIMIT 10",
    "profile_date_range": """
        SELECT min(work_date) AS start_date, max(work_date) AS end_date,
               CAST(date_diff('day', min(work_date), max(work_date)) AS BIGINT) AS total_days FROM wf_timesheets""",
    "profile_department_nulls": """
        SELECT coalesce(d, 'MISSING') AS department, employee_count
        FROM (SELECT department AS d, count(*) AS employee_count FROM wf_employees GROUP BY department)
        ORDER BY employee_count DESC""",
    "profile_hours": """
        SELECT count(*) AS total_rows,
               CAST(sum(CASE WHEN hours_worked < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_count,
               CAST(sum(CASE WHEN hours_worked = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_count,
               CAST(sum(CASE WHEN hours_worked > 0 THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
               r2(min(hours_worked), 2) AS min_hours, r2(max(hours_worked), 2) AS max_hours
        FROM wf_timesheets""",
    "profile_messy_names": """
        SELECT name, length(name) AS name_length FROM wf_employees
        WHERE name LIKE ' %' OR name LIKE '% ' ORDER BY emp_id LIMIT 10""",
    "profile_regions": "SELECT region, count(*) AS employee_count FROM wf_employees GROUP BY region ORDER BY region",
    "profile_currencies": f"""
        SELECT currency, count(*) AS employee_count, {_profile_share(1)},
               r2(min(local_salary), 2) AS min_salary, r2(max(local_salary), 2) AS max_salary,
               {_avg('local_salary')} AS avg_salary
        FROM wf_employees GROUP BY currency ORDER BY employee_count DESC""",
    "profile_fx": """
        SELECT currency_code, base_currency, count(*) AS monthly_snapshots, min(fx_month) AS earliest,
               max(fx_month) AS latest, r2(min(rate_to_usd), 6) AS min_rate, r2(max(rate_to_usd), 6) AS max_rate
        FROM wf_exchange_rates GROUP BY currency_code, base_currency ORDER BY currency_code""",
    "profile_designations": """
        SELECT designation, count(*) AS employee_count FROM wf_employees
        GROUP BY designation ORDER BY employee_count DESC""",
    "profile_markets": """
        SELECT client_country, count(*) AS project_count, r2(count(*) * 100e0 / 100, 1) AS pct
        FROM wf_projects WHERE project_id <> -1 GROUP BY client_country ORDER BY project_count DESC""",
    "profile_markets_counted": f"""
        SELECT client_country, count(*) AS project_count, {_profile_share(1)}
        FROM wf_projects WHERE project_id <> -1 GROUP BY client_country ORDER BY project_count DESC""",
    "profile_bench_row": "SELECT * FROM wf_projects WHERE project_id = -1",
    "profile_entry_types": f"""
        SELECT entry_type, is_correction, count(*) AS row_count, {_profile_share(2)},
               {_money('revenue_usd')} AS total_revenue_usd, {_avg('hours_worked')} AS avg_hours
        FROM wf_timesheets GROUP BY entry_type, is_correction ORDER BY entry_type""",
    "profile_uuid_uniqueness": """
        SELECT count(*) AS total_rows, count(DISTINCT timesheet_id) AS unique_ids,
               count(*) - count(DISTINCT timesheet_id) AS duplicate_count FROM wf_timesheets""",
    "profile_batches": """
        SELECT batch_id, count(*) AS rows_in_batch, min(load_timestamp) AS batch_start,
               max(load_timestamp) AS batch_end, min(work_date) AS work_date_from, max(work_date) AS work_date_to
        FROM wf_timesheets GROUP BY batch_id ORDER BY batch_start DESC, batch_id LIMIT 10""",
    "dim_date": _CALENDAR,
    "fx_carry_forward": """
        , turns AS (SELECT DISTINCT fx_month, (year(fx_month) * 12 + month(fx_month)) % 9 AS turn FROM wf_exchange_rates),
        fetched AS (
          SELECT x.fx_month, x.currency_code,
                 r2(1e0 / r2(1e0 / x.rate_to_usd, 6), 6) AS rate_to_usd
          FROM wf_exchange_rates x JOIN turns t ON x.fx_month = t.fx_month
          WHERE turn NOT IN (4, 5) AND x.currency_code <> 'USD'),
        outage AS (
          SELECT fx_month, unnest(['PKR', 'GBP', 'EUR', 'AED', 'SAR', 'SGD']) AS currency_code
          FROM turns WHERE turn IN (4, 5))
        SELECT fx_month, 'USD' AS base_currency, currency_code, rate_to_usd FROM fetched
        UNION ALL
        SELECT o.fx_month, 'USD', o.currency_code, f.rate_to_usd
        FROM outage o ASOF LEFT JOIN fetched f ON o.currency_code = f.currency_code AND o.fx_month >= f.fx_month
        UNION ALL
        SELECT fx_month, 'USD', 'USD', 1e0 FROM turns""",
    "fx_load_documents": """
        , turns AS (SELECT DISTINCT fx_month, (year(fx_month) * 12 + month(fx_month)) % 9 AS turn FROM wf_exchange_rates),
        fetched AS (
          SELECT x.fx_month, x.currency_code,
                 r2(1e0 / r2(1e0 / x.rate_to_usd, 6), 6) AS rate_to_usd
          FROM wf_exchange_rates x JOIN turns t ON x.fx_month = t.fx_month
          WHERE turn NOT IN (4, 5) AND x.currency_code <> 'USD'),
        outage AS (
          SELECT fx_month, unnest(['PKR', 'GBP', 'EUR', 'AED', 'SAR', 'SGD']) AS currency_code
          FROM turns WHERE turn IN (4, 5))
        SELECT r.*, CASE turn WHEN 4 THEN 'not a JSON document' WHEN 5 THEN 'a rate without reciprocal' END AS fault
        FROM (
        SELECT fx_month, 'USD' AS base_currency, currency_code, rate_to_usd FROM fetched
        UNION ALL
        SELECT o.fx_month, 'USD', o.currency_code, f.rate_to_usd
        FROM outage o ASOF LEFT JOIN fetched f ON o.currency_code = f.currency_code AND o.fx_month >= f.fx_month
        UNION ALL
        SELECT fx_month, 'USD', 'USD', 1e0 FROM turns) r JOIN turns t ON r.fx_month = t.fx_month""",
    "fx_new_keys": """
        SELECT * FROM wf_exchange_rates WHERE fx_month >= DATE '1999-01-01' AND currency_code <> 'GBP'""",
    "fx_duplicate_keys": """
        SELECT fx_month, currency_code, CAST(2 AS BIGINT) AS row_count
        FROM wf_exchange_rates WHERE month(fx_month) = 1""",
    "client_projects": "SELECT project_id, client_country FROM wf_projects WHERE project_id <> -1",
    "projects_with_bench": "SELECT * FROM wf_projects",
    "schedule_asof": """
        SELECT e.event_id, e.user_id AS emp_id, CAST(e.ts AS DATE) AS work_date,
               CASE WHEN CAST(e.ts AS DATE) <= s.end_date THEN s.project_id ELSE -1 END AS project_id
        FROM events e ASOF LEFT JOIN wf_event_schedule s
          ON e.user_id = s.emp_id AND CAST(e.ts AS DATE) >= s.start_date""",
    "build_schedule": _SCHEDULE.format(horizon="DATE '1998-01-01'", history="DATE '1996-01-01'"),
    "employee_day_spine": """
        , days AS (
          SELECT emp_id, CAST(unnest(generate_series(join_date, DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS work_date
          FROM wf_employees)
        SELECT emp_id, CAST(date_trunc('month', work_date) AS DATE) AS fx_month, count(*) AS day_count,
               min(work_date) AS first_day, max(work_date) AS last_day
        FROM days
        WHERE (isodow(work_date) < 6 OR (emp_id, work_date) IN (SELECT (emp_id, work_date) FROM wf_weekend_work))
          AND (emp_id, work_date) NOT IN (SELECT (emp_id, work_date) FROM wf_absences)
        GROUP BY ALL""",
    # The rate card.
    "rate_card_lookup": """
        , bands(market, low, high) AS (VALUES
          ('USA', 55, 95), ('United Kingdom', 50, 85), ('Australia', 50, 80), ('Canada', 48, 80),
          ('Germany', 45, 75), ('Netherlands', 45, 75), ('United Arab Emirates', 42, 70),
          ('Saudi Arabia', 40, 68), ('Singapore', 38, 65), ('Qatar', 40, 65)),
        factors(designation, factor) AS (VALUES
          ('consultant', 0.90e0), ('Analyst', 1.00e0), ('MANAGER', 1.40e0), ('manager', 1.40e0),
          ('SENIOR ANALYST', 1.30e0)),
        years(y, factor) AS (VALUES (2023, 1.00e0), (2024, 1.08e0), (2025, 1.17e0), (2026, 1.26e0)),
        days AS (
          SELECT t.timesheet_id, t.load_timestamp, CAST(t.work_date + INTERVAL 28 YEAR AS DATE) AS work_date,
                 m.client_country, r.designation
          FROM wf_timesheets t LEFT JOIN wf_markets m ON t.project_id = m.project_id
          JOIN wf_roster r ON t.emp_id = r.emp_id)
        SELECT timesheet_id, load_timestamp, work_date, client_country, d.designation,
               CAST(coalesce(low, 40) AS DOUBLE) AS rate_low, CAST(coalesce(high, 65) AS DOUBLE) AS rate_high,
               r2((coalesce(low, 40) + coalesce(high, 65)) / 2e0 * coalesce(y.factor, 1.26e0) * coalesce(f.factor, 1e0), 2)
                 AS hourly_rate_usd
        FROM days d LEFT JOIN bands b ON d.client_country = b.market
        LEFT JOIN factors f ON d.designation = f.designation
        LEFT JOIN years y ON year(d.work_date) = y.y""",
    "salary_band_check": """
        , bands(region, low, high, currency) AS (VALUES
          ('pakistan', 80000, 600000, 'PKR'), ('usa', 5000, 15000, 'USD'), ('united kingdom', 4000, 10000, 'GBP'),
          ('uae', 15000, 40000, 'AED'), ('germany', 4000, 11000, 'EUR'), ('saudi arabia', 15000, 40000, 'SAR'),
          ('singapore', 6000, 15000, 'SGD')),
        factors(designation, low, high) AS (VALUES
          ('consultant', 6e-1, 75e-2), ('Analyst', 75e-2, 88e-2), ('MANAGER', 88e-2, 1e0),
          ('manager', 88e-2, 1e0), ('SENIOR ANALYST', 1e0, 13e-1)),
        banded AS (
          SELECT r.*, r2(CAST(b.low AS DOUBLE) * coalesce(f.low, 75e-2), 2) AS band_min,
                 r2(CAST(b.high AS DOUBLE) * coalesce(f.high, 1e0), 2) AS band_max, b.currency AS band_currency
          FROM wf_roster r LEFT JOIN bands b ON lower(r.region) = b.region
          LEFT JOIN factors f ON r.designation = f.designation)
        SELECT *, local_salary >= band_min AND local_salary <= band_max AS in_band FROM banded""",
    "non_billable_chance": """
        , shares(department, share) AS (VALUES
          ('Engineering', 8e-2), ('Data Science', 10e-2), ('Cloud', 9e-2), ('Sales', 12e-2),
          ('HR', 30e-2), ('QA', 20e-2), ('Unassigned', 25e-2)),
        season(m, billable) AS (VALUES
          (1, 77e-2), (2, 79e-2), (3, 83e-2), (4, 86e-2), (5, 88e-2), (6, 87e-2), (7, 91e-2),
          (8, 90e-2), (9, 88e-2), (10, 85e-2), (11, 83e-2), (12, 79e-2))
        SELECT t.timesheet_id, t.load_timestamp, t.emp_id, t.project_id, t.work_date, r.department,
               CASE WHEN t.project_id = -1 THEN 1e0
                    ELSE greatest(3e-2, least(20e-2, coalesce(s.share, 15e-2) * (1e0 - n.billable + 10e-2)))
               END AS non_billable_chance
        FROM wf_timesheets t JOIN wf_roster r ON t.emp_id = r.emp_id
        LEFT JOIN shares s ON coalesce(r.department, 'Unassigned') = s.department
        JOIN season n ON month(t.work_date) = n.m""",
    "fact_metrics": f"""
        , m AS ({_METRICS.format(entries='wf_entries')})
        SELECT timesheet_id, emp_id, project_id, work_date, CAST(date_trunc('month', work_date) AS DATE) AS fx_month,
               CAST(work_date AS TIMESTAMP) AS created_at, hours_worked, is_billable, hourly_rate_usd,
               {_REVENUE.format(h='hours_worked')} AS revenue_usd, allocation_pct, hours_worked < 0 AS is_anomaly,
               isodow(work_date) >= 6 AS is_weekend_work, FALSE AS is_correction, 'original' AS entry_type,
               CAST(NULL AS STRING) AS original_timesheet_id, TIMESTAMP '2002-01-01 02:00:00' AS load_timestamp,
               'RUN-20020101-020000-00000001' AS batch_id
        FROM m""",
    "fact_quarantine": f"""
        , m AS ({_METRICS.format(entries='wf_entries')})
        SELECT timesheet_id, project_id, hours_worked, allocation_pct,
               CASE WHEN abs(hours_worked) > 8 THEN 'hours out of range'
                    WHEN allocation_pct <= 0 OR allocation_pct > 1 THEN 'allocation out of range' END AS reason
        FROM m""",
    "fact_row_id": """
        SELECT timesheet_id, load_timestamp, sha256(emp_id || '|' || work_date || '|' || entry_type) AS row_id
        FROM wf_timesheets""",
    "apply_corrections": f"""
        , fixes AS (
          SELECT s.* EXCLUDE (timesheet_id, original_timesheet_id, entry_type, is_correction, is_anomaly, hours_worked, revenue_usd),
                 sha256(emp_id || '|' || work_date || '|correction') AS timesheet_id, s.timesheet_id AS original_timesheet_id,
                 'correction' AS entry_type, TRUE AS is_correction, TRUE AS is_anomaly,
                 {_DELTA} AS hours_worked
          FROM silver_timesheets s JOIN wf_adjustments a ON s.timesheet_id = a.timesheet_id
          WHERE s.entry_type = 'original' AND s.hours_worked > 0)
        SELECT {_FACT} FROM silver_timesheets
        UNION ALL
        SELECT {_FACT} FROM (SELECT *, {_REVENUE.format(h='hours_worked')} AS revenue_usd FROM fixes)""",
    "correction_lineage": """
        SELECT c.timesheet_id, c.original_timesheet_id, c.work_date, c.hours_worked AS correction_hours,
               c.revenue_usd AS correction_revenue_usd, o.hours_worked AS original_hours,
               o.hours_worked + c.hours_worked AS net_hours, o.timesheet_id IS NOT NULL AS original_found
        FROM silver_timesheets c LEFT JOIN silver_timesheets o
          ON c.original_timesheet_id = o.timesheet_id AND NOT o.is_correction
        WHERE c.is_correction""",
    "broken_references": """
        SELECT timesheet_id, original_timesheet_id FROM silver_timesheets
        WHERE is_correction AND original_timesheet_id NOT IN
          (SELECT timesheet_id FROM silver_timesheets WHERE NOT is_correction)""",
    "natural_key_duplicates": """
        SELECT emp_id, work_date, entry_type, count(*) AS row_count FROM wf_timesheets
        GROUP BY ALL HAVING count(*) > 1""",
    "natural_key_duplicate_rows": """
        SELECT emp_id, work_date, entry_type, timesheet_id, load_timestamp, hours_worked
        FROM (SELECT *, count(*) OVER (PARTITION BY emp_id, work_date, entry_type) AS n FROM wf_timesheets)
        WHERE n > 1""",
    "expectation_report": """
        , observed AS (
          SELECT 'history_start_offset_days' AS expectation, date_diff('day', DATE '1995-01-02', min(work_date)) AS observed, 0 AS low, 0 AS high FROM wf_timesheets
          UNION ALL SELECT 'history_end_lag_days', date_diff('day', max(work_date), DATE '2001-12-31'), 0, 0 FROM wf_timesheets
          UNION ALL SELECT 'negative_hours_pct', count(*) FILTER (WHERE hours_worked < 0) * 100e0 / count(*), 1, 3 FROM wf_timesheets
          UNION ALL SELECT 'correction_pct', count(*) FILTER (WHERE entry_type = 'correction') * 100e0 / count(*), 1, 3 FROM wf_timesheets
          UNION ALL SELECT 'duplicate_ids', count(*) - count(DISTINCT timesheet_id), 0, 0 FROM wf_timesheets
          UNION ALL SELECT 'null_department_pct', count(*) FILTER (WHERE department IS NULL) * 100e0 / count(*), 5, 9 FROM wf_employees
          UNION ALL SELECT 'padded_name_pct', count(*) FILTER (WHERE name LIKE ' %' OR name LIKE '% ') * 100e0 / count(*), 15, 25 FROM wf_employees
          UNION ALL SELECT 'pkr_salary_pct', count(*) FILTER (WHERE currency = 'PKR') * 100e0 / count(*), 70, 80 FROM wf_employees
          UNION ALL SELECT 'client_projects', count(*) FILTER (WHERE project_id <> -1), 100, 100 FROM wf_projects
          UNION ALL SELECT 'bench_rows', count(*) FILTER (WHERE project_id = -1), 1, 1 FROM wf_projects
          UNION ALL SELECT 'fx_rows', count(*), 560, 600 FROM wf_exchange_rates)
        SELECT expectation, CAST(observed AS DOUBLE) AS observed, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high,
               observed >= low AND observed <= high AS passed FROM observed""",
    "incremental_start": """
        SELECT max(work_date) AS last_loaded, coalesce(max(work_date) + 1, DATE '2023-01-01') AS next_start
        FROM wf_timesheets""",
    "incremental_load": f"""
        , timeline AS ({_SCHEDULE.format(horizon="DATE '2001-12-31'", history="DATE '1995-01-01'")}),
        open_entries AS (
          SELECT d.* FROM wf_daily_entries d JOIN wf_employees e ON d.emp_id = e.emp_id
          WHERE d.work_date >= greatest(e.join_date, DATE '1995-01-01') AND d.work_date <= DATE '2001-12-31'
            AND (isodow(d.work_date) < 6 OR (d.emp_id, d.work_date) IN (SELECT (emp_id, work_date) FROM wf_weekend_work))
            AND (d.emp_id, d.work_date) NOT IN (SELECT (emp_id, work_date) FROM wf_absences)),
        staffed AS (
          SELECT o.*, CASE WHEN o.work_date <= t.end_date THEN t.project_id END AS project_id
          FROM open_entries o ASOF LEFT JOIN timeline t ON o.emp_id = t.emp_id AND o.work_date >= t.start_date),
        m AS ({_METRICS.format(entries='staffed')}),
        originals AS (
          SELECT *, 'original' AS entry_type, CAST(NULL AS STRING) AS original_timesheet_id FROM m
          WHERE abs(hours_worked) <= 8 AND allocation_pct > 0 AND allocation_pct <= 1),
        fixes AS (
          SELECT o.emp_id, o.work_date, project_id, is_billable, allocation_pct, hourly_rate_usd,
                 {_DELTA} AS hours_worked,
                 sha256(o.emp_id || '|' || o.work_date || '|correction') AS timesheet_id,
                 'correction' AS entry_type, o.timesheet_id AS original_timesheet_id
          FROM originals o JOIN wf_daily_adjustments a ON o.emp_id = a.emp_id AND o.work_date = a.work_date
          WHERE o.hours_worked > 0)
        SELECT timesheet_id, emp_id, project_id, work_date, CAST(date_trunc('month', work_date) AS DATE) AS fx_month,
               CAST(work_date AS TIMESTAMP) AS created_at, hours_worked, is_billable, hourly_rate_usd,
               {_REVENUE.format(h='hours_worked')} AS revenue_usd, allocation_pct,
               entry_type = 'correction' OR hours_worked < 0 AS is_anomaly,
               isodow(work_date) >= 6 AS is_weekend_work, entry_type = 'correction' AS is_correction,
               entry_type, original_timesheet_id
        FROM (SELECT * FROM originals UNION ALL BY NAME SELECT * FROM fixes)""",
    "daily_run": f"""
        , timeline AS ({_SCHEDULE.format(horizon="DATE '2001-12-31'", history="DATE '1995-01-01'")}),
        bands(market, low, high) AS (VALUES
          ('USA', 55, 95), ('United Kingdom', 50, 85), ('Australia', 50, 80), ('Canada', 48, 80),
          ('Germany', 45, 75), ('Netherlands', 45, 75), ('United Arab Emirates', 42, 70),
          ('Saudi Arabia', 40, 68), ('Singapore', 38, 65), ('Qatar', 40, 65)),
        factors(designation, factor) AS (VALUES
          ('consultant', 0.90e0), ('Analyst', 1.00e0), ('MANAGER', 1.40e0), ('manager', 1.40e0),
          ('SENIOR ANALYST', 1.30e0)),
        open_entries AS (
          SELECT d.*, e.designation FROM wf_daily_entries d JOIN wf_employees e ON d.emp_id = e.emp_id
          WHERE d.work_date >= greatest(e.join_date, DATE '1995-01-01') AND d.work_date <= DATE '2001-12-31'
            AND (isodow(d.work_date) < 6 OR (d.emp_id, d.work_date) IN (SELECT (emp_id, work_date) FROM wf_weekend_work))
            AND (d.emp_id, d.work_date) NOT IN (SELECT (emp_id, work_date) FROM wf_absences)),
        placed AS (
          SELECT o.*, CASE WHEN o.work_date <= t.end_date THEN t.project_id END AS project_id
          FROM open_entries o ASOF LEFT JOIN timeline t ON o.emp_id = t.emp_id AND o.work_date >= t.start_date),
        staffed AS (
          SELECT p.* EXCLUDE (hourly_rate_usd, designation),
                 r2((coalesce(b.low, 40) + coalesce(b.high, 65)) / 2e0 * 1.26e0 * coalesce(f.factor, 1e0), 2) AS hourly_rate_usd
          FROM placed p LEFT JOIN wf_markets m ON p.project_id = m.project_id
          LEFT JOIN bands b ON m.client_country = b.market
          LEFT JOIN factors f ON p.designation = f.designation),
        m AS ({_METRICS.format(entries='staffed')}),
        originals AS (
          SELECT *, 'original' AS entry_type FROM m
          WHERE abs(hours_worked) <= 8 AND allocation_pct > 0 AND allocation_pct <= 1),
        fixes AS (
          SELECT o.emp_id, o.work_date, project_id, is_billable, allocation_pct, hourly_rate_usd,
                 {_DELTA} AS hours_worked,
                 sha256(o.emp_id || '|' || o.work_date || '|correction') AS timesheet_id, 'correction' AS entry_type
          FROM originals o JOIN wf_daily_adjustments a ON o.emp_id = a.emp_id AND o.work_date = a.work_date
          WHERE o.hours_worked > 0)
        SELECT timesheet_id, emp_id, work_date, project_id, entry_type, hours_worked, hourly_rate_usd,
               {_REVENUE.format(h='hours_worked')} AS revenue_usd
        FROM (SELECT * FROM originals UNION ALL BY NAME SELECT * FROM fixes)""",
    "profile_uuid_sketches": """
        SELECT year(work_date) AS year, count(DISTINCT timesheet_id) AS distinct_ids, TRUE AS estimate_is_near
        FROM wf_timesheets GROUP BY ALL""",
    "streaming_load": f"""
        , daily AS (SELECT *, own_project AS project_id FROM wf_daily_entries),
        m AS ({_METRICS.format(entries='daily')})
        SELECT timesheet_id, emp_id, project_id, work_date, CAST(date_trunc('month', work_date) AS DATE) AS fx_month,
               CAST(work_date AS TIMESTAMP) AS created_at, hours_worked, is_billable, hourly_rate_usd,
               {_REVENUE.format(h='hours_worked')} AS revenue_usd, allocation_pct, hours_worked < 0 AS is_anomaly,
               isodow(work_date) >= 6 AS is_weekend_work, FALSE AS is_correction, 'original' AS entry_type,
               CAST(NULL AS STRING) AS original_timesheet_id
        FROM m WHERE abs(hours_worked) <= 8 AND allocation_pct > 0 AND allocation_pct <= 1""",
    "load_quarantine": f"""
        , timeline AS ({_SCHEDULE.format(horizon="DATE '2001-12-31'", history="DATE '1995-01-01'")}),
        staff AS (SELECT emp_id, join_date FROM wf_employees WHERE department IS NOT NULL),
        dated AS (
          SELECT * EXCLUDE (project_id) FROM wf_entries
          WHERE work_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'),
        staffed AS (
          SELECT d.*, CASE WHEN d.work_date <= t.end_date THEN t.project_id END AS project
          FROM dated d ASOF LEFT JOIN timeline t ON d.emp_id = t.emp_id AND d.work_date >= t.start_date),
        measured AS (
          SELECT emp_id, work_date, coalesce(project, -1) AS project_id,
                 sha256(emp_id || '|' || work_date || '|original') AS timesheet_id,
                 project IS NOT NULL AND is_billable AS billable,
                 CASE WHEN project IS NOT NULL AND is_billable THEN hourly_rate_usd ELSE 0e0 END AS rate,
                 CASE WHEN project IS NULL THEN 1e0 ELSE allocation_pct END AS allocation_pct,
                 CASE WHEN project IS NULL THEN base_hours
                      ELSE {_HALF_HOURS.format(x='base_hours * allocation_pct')} END AS hours_worked
          FROM staffed),
        judged AS (
          SELECT m.*, CASE
                   WHEN s.emp_id IS NULL THEN 'unknown employee'
                   WHEN m.work_date < s.join_date THEN 'before joining'
                   WHEN (m.emp_id, m.work_date) IN (SELECT (emp_id, work_date) FROM wf_absences) THEN 'absent'
                   WHEN isodow(m.work_date) >= 6
                     AND (m.emp_id, m.work_date) NOT IN (SELECT (emp_id, work_date) FROM wf_weekend_work)
                   THEN 'weekend not listed'
                   WHEN abs(hours_worked) > 8 THEN 'hours out of range'
                   WHEN allocation_pct <= 0 OR allocation_pct > 1 THEN 'allocation out of range' END AS reason
          FROM measured m LEFT JOIN staff s ON m.emp_id = s.emp_id),
        versions AS (
          SELECT timesheet_id FROM (
            SELECT DISTINCT timesheet_id, project_id, hours_worked, allocation_pct, billable, rate
            FROM judged WHERE reason IS NULL)
          GROUP BY timesheet_id HAVING count(*) > 1),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY timesheet_id, reason) AS turn FROM judged)
        SELECT timesheet_id, emp_id, work_date, project_id, hours_worked, allocation_pct,
               CASE WHEN reason IS NOT NULL THEN reason
                    WHEN timesheet_id IN (SELECT timesheet_id FROM versions) THEN 'conflict'
                    WHEN turn > 1 THEN 'repeat' ELSE 'accepted' END AS reason
        FROM numbered""",
    "streaming_conflicts": f"""
        , delivered AS (
          SELECT o_custkey AS emp_id, CAST(l_shipdate AS DATE) AS work_date,
                 CASE WHEN l_suppkey % 10 <> 0 THEN l_suppkey + 1 END AS project_id, q * 25e-2 AS base_hours,
                 CASE l_linenumber % 5 WHEN 0 THEN 0e0 WHEN 1 THEN 6e-1 WHEN 2 THEN 8e-1 WHEN 3 THEN 1e0 ELSE 12e-1 END
                   AS allocation_pct,
                 l_linestatus = 'F' AS is_billable, CAST(40 + l_suppkey % 56 AS DOUBLE) AS hourly_rate_usd,
                 row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, q, l_linestatus) AS turn
          FROM wf_raw),
        measured AS (
          SELECT emp_id, work_date, coalesce(project_id, -1) AS project_id, turn,
                 sha256(emp_id || '|' || work_date || '|original') AS timesheet_id,
                 project_id IS NOT NULL AND is_billable AS is_billable,
                 CASE WHEN project_id IS NOT NULL AND is_billable THEN hourly_rate_usd ELSE 0e0 END AS hourly_rate_usd,
                 CASE WHEN project_id IS NULL THEN 1e0 ELSE allocation_pct END AS allocation_pct,
                 CASE WHEN project_id IS NULL THEN base_hours
                      ELSE {_HALF_HOURS.format(x='base_hours * allocation_pct')} END AS hours_worked
          FROM delivered),
        fit AS (
          SELECT *, min(turn) OVER (PARTITION BY timesheet_id) AS first_turn FROM measured
          WHERE abs(hours_worked) <= 8 AND allocation_pct > 0 AND allocation_pct <= 1),
        facts AS (
          SELECT timesheet_id, emp_id, work_date, project_id, hours_worked, allocation_pct, is_billable, hourly_rate_usd
          FROM fit WHERE turn = first_turn),
        others AS (
          SELECT timesheet_id, emp_id, work_date, project_id, hours_worked, allocation_pct, is_billable, hourly_rate_usd
          FROM fit WHERE turn > first_turn
          EXCEPT SELECT * FROM facts)
        SELECT *, 'accepted' AS reason FROM facts
        UNION ALL SELECT *, 'conflict' AS reason FROM others
        UNION ALL
        SELECT DISTINCT timesheet_id, emp_id, work_date, project_id, hours_worked, allocation_pct, is_billable,
               hourly_rate_usd,
               CASE WHEN abs(hours_worked) > 8 THEN 'hours out of range' ELSE 'allocation out of range' END AS reason
        FROM measured WHERE abs(hours_worked) > 8 OR allocation_pct <= 0 OR allocation_pct > 1""",
}


def _null_report():
    """One select per column, so that the oracle shares nothing with the report it checks."""
    tables = {
        ("wf_employees", "dim_employees"): (
            ["emp_id", "name"],
            ["department", "designation", "local_salary", "currency", "region", "join_date"]),
        ("wf_projects", "dim_projects"): (
            ["project_id", "project_name"],
            ["client_name", "client_country"]),
        ("wf_exchange_rates", "dim_exchange_rates"): (
            ["fx_month", "base_currency", "currency_code"],
            ["rate_to_usd"]),
        ("wf_timesheets", "fact_timesheets"): (
            ["timesheet_id", "emp_id", "project_id", "work_date", "fx_month", "created_at", "hours_worked",
             "is_billable", "hourly_rate_usd", "revenue_usd", "allocation_pct", "is_anomaly", "is_weekend_work",
             "is_correction", "entry_type", "load_timestamp", "batch_id"],
            ["original_timesheet_id"]),
    }
    lines = []
    for (source, table), (required, optional) in tables.items():
        for needed, columns in ((True, required), (False, optional)):
            for column in columns:
                passed = f"count(*) = count({column})" if needed else "TRUE"
                lines.append(
                    f"SELECT '{table}' AS table_name, '{column}' AS column_name, {needed} AS is_required, "
                    f"count(*) - count({column}) AS null_count, {passed} AS passed FROM {source}"
                )
    return "\nUNION ALL ".join(lines)


ORACLES["not_null_report"] = _null_report()


def oracles():
    """Oracle text by query key; a query that starts with a comma adds its own tables."""
    return {key: with_lens(text.strip()) for key, text in ORACLES.items()}
