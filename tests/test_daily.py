import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterlake.plans import daily
from rosterlake.plans.profile import daily_id_sketches, distinct_ids
from rosterlake.schemas import EMPLOYEES, FX_DOCUMENT, PROJECTS
from tests.conftest import day, rows

DAYS = "emp_id long, work_date date"


@pytest.fixture
def sources(spark):
    people = [(1, "ann", "QA", "MANAGER", 1.0, "PKR", "USA", day("2023-01-01")),
              (2, "bob", "QA", "intern", 1.0, "PKR", "USA", day("2023-01-01"))]
    entries = [(e, day(f"2024-01-{d:02d}"), 8.0, 1.0, True) for e in (1, 2) for d in range(1, 13)]
    return daily.Sources(
        employees=spark.createDataFrame(people, EMPLOYEES),
        projects=spark.createDataFrame([(5, "p", "c", "USA")], PROJECTS),
        documents=spark.createDataFrame([(day("2024-01-01"), {"PKR": 250.0})], FX_DOCUMENT),
        cycles=spark.createDataFrame([(1, day("2023-01-01"), [5])], "emp_id long, join_date date, project_ids array<long>"),
        assignments=spark.createDataFrame([(1, 0, 400, 0)], "emp_id long, seq long, duration_days long, gap_days long"),
        entries=spark.createDataFrame(
            entries, "emp_id long, work_date date, base_hours double, allocation_pct double, is_billable boolean"),
        absences=spark.createDataFrame([], DAYS), weekend_work=spark.createDataFrame([], DAYS),
        adjustments=spark.createDataFrame([], "emp_id long, work_date date, adjusted_hours double"),
        history_start=day("2024-01-01"), currencies=("PKR",),
    )


def test_two_days_and_a_repeat(lake, sources):
    first = daily.daily_run(lake, sources, day("2024-01-05"))
    assert rows(first, "step", "row_count") == sorted([
        ("calendar", 5), ("employees", 2), ("projects", 2), ("exchange_rates", 2), ("facts", 10), ("views", 6)])
    daily.daily_run(lake, sources, day("2024-01-12"))
    assert lake.read("fact_timesheets").count() == 20
    assert daily.daily_run(lake, sources, day("2024-01-12")).count() == 6
    # the rate card: 55 to 95 in the market, 1.08 in the year, 1.4 for the designation; the bench has no rate
    rates = lake.read("fact_timesheets").select("emp_id", "project_id", "hourly_rate_usd").distinct()
    assert rows(rates) == [(1, 5, 113.4), (2, -1, 0.0)]
    assert lake.spark.newSession().table(lake.name("gold_timesheets_enriched")).count() == 20


@pytest.mark.parametrize("step", list(daily.STEPS))
def test_a_run_resumes_with_the_step_that_failed(lake, sources, monkeypatch, step):
    ran = []

    def watched(name, function):
        def run(*arguments):
            ran.append(name)
            return function(*arguments)
        return run

    steps = {name: watched(name, function) for name, function in daily.STEPS.items()}
    killed = {**steps, step: watched(step, lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))}
    monkeypatch.setattr(daily, "STEPS", killed)
    with pytest.raises(RuntimeError, match="killed"):
        daily.daily_run(lake, sources, day("2024-01-03"))
    monkeypatch.setattr(daily, "STEPS", steps)
    daily.daily_run(lake, sources, day("2024-01-03"))
    names = list(steps)
    assert ran == names[:names.index(step) + 1] + names[names.index(step):]
    assert lake.read("fact_timesheets").count() == 6


def test_a_step_without_its_journal_entry_changes_nothing(lake, sources, monkeypatch):
    """The driver dies after the facts and before their entry."""
    append = lake.append

    def lost(frame, table):
        if table == daily.JOURNAL and frame.filter("step = 'facts'").count():
            raise RuntimeError("lost")
        return append(frame, table)

    monkeypatch.setattr(lake, "append", lost)
    with pytest.raises(RuntimeError, match="lost"):
        daily.daily_run(lake, sources, day("2024-01-03"))
    monkeypatch.setattr(lake, "append", append)
    daily.daily_run(lake, sources, day("2024-01-03"))
    assert lake.read("fact_timesheets").count() == 6


def test_sketches_of_days_merge(spark):
    facts = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("work_date"),
        (F.col("id") % 20_000).cast("string").alias("timesheet_id"))
    sketches = daily_id_sketches(facts)
    assert sketches.count() == 30
    for last in (dt.date(2024, 1, 1), dt.date(2024, 1, 7), dt.date(2024, 1, 30)):
        exact = facts.filter(F.col("work_date") <= F.lit(last)).select("timesheet_id").distinct().count()
        found = sketches.filter(F.col("work_date") <= F.lit(last)).agg(distinct_ids(F.col("id_sketch"))).first()[0]
        assert abs(found - exact) <= 0.05 * exact
