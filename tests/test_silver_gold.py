import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterlake.plans import gold, silver, views
from rosterlake.schemas import EMPLOYEES, EXCHANGE_RATES, PROJECTS, TIMESHEETS
from tests.conftest import day, rows

NOON = dt.datetime(2024, 1, 10, 12)


def sheet(sheet_id="t1", emp=1, project=-1, work="2024-01-10", hours=2.0, billable=False,
          correction=False, loaded=NOON, batch="b1", original=None, created=NOON):
    date = day(work)
    return (sheet_id, emp, project, date, date.replace(day=1), created, hours, billable,
            50.0 if billable else 0.0, hours * 50.0 if billable else 0.0, 1.0, hours < 0, False,
            correction, "correction" if correction else "original", original, loaded, batch)


@pytest.fixture
def dims(spark):
    employees = spark.createDataFrame([
        (1, "  ann lee ", None, "MANAGER", 240000.0, "PKR", "PAKISTAN", day("2023-01-01")),
        (2, "bob", "QA", "Analyst", 9000.0, "SAR", "Saudi Arabia", day("2023-01-01")),
    ], EMPLOYEES)
    projects = spark.createDataFrame([
        (-1, "Bench", "Internal", "Internal"), (7, "  PRJ-X  ", " Acme ", "USA"),
    ], PROJECTS)
    rates = spark.createDataFrame([
        (day("2024-01-01"), "USD", "PKR", 0.004),
        (day("2024-01-01"), "USD", "SAR", 0.26),
        (day("2024-02-01"), "USD", "PKR", 0.005),
    ], EXCHANGE_RATES)
    return employees, projects, rates


def enriched(spark, dims, *sheets):
    employees, projects, rates = dims
    return gold.gold_from_bronze(spark.createDataFrame(sheets, TIMESHEETS), employees, projects, rates)


def test_silver_employees(dims):
    assert rows(silver.silver_employees(dims[0]), "full_name", "department", "designation_level", "region") == [
        ("Ann Lee", "Unassigned", "Manager", "Pakistan"), ("Bob", "QA", "Analyst", "Saudi Arabia"),
    ]


def test_silver_projects(dims):
    assert rows(silver.silver_projects(dims[1]))[1][:3] == (7, "PRJ-X", "Acme")


def test_latest_version_wins_and_zero_hours_hide_older(spark, dims):
    sheets = [sheet(hours=8.0, loaded=NOON), sheet(hours=0.0, loaded=NOON + dt.timedelta(hours=1))]
    kept = silver.silver_timesheets(spark.createDataFrame(sheets, TIMESHEETS))
    assert rows(kept, "hours_worked") == [(0.0,)]
    assert kept.columns == TIMESHEETS.fieldNames()
    assert enriched(spark, dims, *sheets).count() == 0


def test_prune_key_gives_the_same_rows(spark):
    frame = spark.createDataFrame([sheet(), sheet(loaded=NOON + dt.timedelta(1)), sheet("t2")], TIMESHEETS)
    assert rows(silver.silver_timesheets(frame)) == rows(
        silver.silver_timesheets(frame, prune_key="work_date"))


def test_narrow_read_breaks_ties_as_the_full_read(spark):
    """Versions that differ in any column, loaded at the same instant."""
    versions = [
        sheet(hours=h, project=p, created=NOON + dt.timedelta(hours=c), original=o, batch=b)
        for h in (1.0, 2.0) for p in (7, -1) for c in (0, 1) for o in ("x", None) for b in ("b1", "b2")
    ]
    frame = spark.createDataFrame(versions, TIMESHEETS)
    full = silver.silver_timesheets(frame)
    for columns in (["batch_id"], ["hours_worked", "project_id"], gold.FACT_COLUMNS, ["created_at"],
                    ["original_timesheet_id"]):
        assert rows(silver.silver_timesheets(frame, columns)) == rows(full, *columns)


def test_bench_cost(spark, dims):
    got = enriched(spark, dims, sheet("a"), sheet("b", project=7, billable=True))
    assert rows(got, "timesheet_id", "bench_cost_usd", "salary_usd") == [
        ("a", 8.0, 960.0), ("b", 0.0, 960.0)]


def test_rows_gold_leaves_out(spark, dims):
    got = enriched(
        spark, dims, sheet("kept"), sheet("zero", hours=0.0), sheet("fix", hours=-1.0, correction=True),
        sheet("no-rate", emp=2, work="2024-02-05"), sheet("no-employee", emp=9), sheet("no-project", project=99),
        sheet("no-month", work="2024-03-05"),
    )
    assert rows(got, "timesheet_id") == [("kept",)]


def test_each_row_takes_its_own_month(spark, dims):
    got = enriched(spark, dims, sheet("jan"), sheet("feb", work="2024-02-05"))
    assert rows(got, "timesheet_id", "salary_usd") == [("feb", 1200.0), ("jan", 960.0)]


def test_gold_employees_latest_month_is_global(dims):
    got = gold.gold_employees(silver.silver_employees(dims[0]), silver.silver_exchange_rates(dims[2]))
    assert rows(got, "emp_id", "salary_usd") == [(1, 1200.0), (2, None)]


def test_totals(spark, dims):
    got = gold.gold_totals(enriched(spark, dims, sheet("a"), sheet("b", project=7, billable=True)))
    assert rows(got) == [(100.0, 8.0)]


def test_views_answer_sql(spark, dims):
    employees, projects, rates = dims
    facts = spark.createDataFrame([sheet("a"), sheet("z", hours=0.0)], TIMESHEETS)
    names = set(views.register_views(employees, projects, rates, facts))
    assert names == {"silver_employees", "silver_projects", "silver_timesheets",
                     "silver_exchange_rates", "gold_employees", "gold_timesheets_enriched"}
    views.register_views(employees, projects, rates, facts)
    got = spark.sql("SELECT sum(bench_cost_usd) AS c FROM gold_timesheets_enriched").head()["c"]
    assert got == 8.0
    assert spark.sql("SELECT count(*) AS n FROM silver_timesheets").head()["n"] == 2


def test_persisted_view(spark, lake, dims):
    lake.replace(dims[2], "dim_exchange_rates")
    spark.sql(f"CREATE OR REPLACE VIEW {lake.name('v')} AS "
              f"SELECT fx_month, currency_code FROM {lake.name('dim_exchange_rates')}")
    assert spark.table(lake.name("v")).count() == 3


def test_gold_properties(spark):
    from verification.queries import QUERIES

    got = QUERIES["gold_timesheets_enriched"](spark, "/root/testdata/sf0.001")
    assert len(got.columns) == 24
    bad = got.filter((F.col("hours_worked") == 0) | (F.col("entry_type") == "correction"))
    assert bad.count() == 0
    assert got.select("timesheet_id").distinct().count() == got.count()
