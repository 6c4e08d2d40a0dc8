import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import checks, keys
from rosterlake.plans import facts, load, projects
from rosterlake.schemas import NATURAL_KEY, PROJECTS, TIMESHEETS
from tests.conftest import day, rows

NOW = dt.datetime(2024, 1, 31, 2, 0)
ENTRY = ("emp_id long, work_date date, project_id long, base_hours double, allocation_pct double, "
         "is_billable boolean, hourly_rate_usd double")


def metrics(spark, *entries):
    return facts.fact_metrics(spark.createDataFrame(entries, ENTRY), "RUN-1", NOW)


def test_metrics(spark):
    got = metrics(
        spark,
        (1, day("2024-01-06"), 7, 7.0, 0.8, True, 60.01),
        (2, day("2024-01-08"), None, 2.7, 0.6, True, 60.0),
        (3, day("2024-01-08"), 7, 2.5, 0.5, False, 60.0),
        (4, day("2024-01-08"), -1, 3.0, 0.6, True, 60.0),
    )
    assert got.columns == TIMESHEETS.names
    assert rows(got, "emp_id", "project_id", "hours_worked", "allocation_pct", "is_billable",
                "hourly_rate_usd", "revenue_usd", "is_weekend_work") == [
        (1, 7, 5.5, 0.8, True, 60.01, 330.06, True),
        (2, -1, 2.7, 1.0, False, 0.0, 0.0, False),
        (3, 7, 1.0, 0.5, False, 0.0, 0.0, False),
        (4, -1, 3.0, 1.0, False, 0.0, 0.0, False),
    ]
    line = got.filter("emp_id = 1").head()
    assert line["fx_month"] == day("2024-01-01") and line["created_at"] == dt.datetime(2024, 1, 6)
    assert line["load_timestamp"] == NOW and line["batch_id"] == "RUN-1"
    assert (line["entry_type"], line["is_correction"], line["is_anomaly"], line["original_timesheet_id"]) == (
        "original", False, False, None)


def test_row_id_survives_a_retry(spark):
    entry = (1, day("2024-01-06"), 7, 7.0, 0.8, True, 60.0)
    first, second = (metrics(spark, entry).head()["timesheet_id"] for _ in range(2))
    assert first == second and len(first) == 64


def test_range_split_is_a_partition(spark):
    frame = metrics(
        spark,
        (1, day("2024-01-08"), 7, 8.0, 1.0, True, 1.0),
        (2, day("2024-01-08"), 7, 8.5, 1.0, True, 1.0),
        (3, day("2024-01-08"), 7, 4.0, 0.0, True, 1.0),
        (4, day("2024-01-08"), 7, 4.0, 1.2, True, 1.0),
        (5, day("2024-01-08"), 7, -8.0, 1.0, True, 1.0),
        (6, day("2024-01-08"), 7, None, 1.0, True, 1.0),
    )
    accepted, rejected = checks.split_by_range(frame)
    assert rows(accepted, "emp_id") == [(1,), (5,)]
    assert rows(rejected, "emp_id", "reason") == [
        (2, "hours out of range"), (3, "allocation out of range"), (4, "allocation out of range"),
        (6, "hours out of range")]
    assert accepted.count() + rejected.count() == frame.count()


@pytest.mark.parametrize("hours, adjusted, expected", [
    (8.0, 2.0, -2.0), (8.0, 9.0, -4.0), (1.5, 3.0, -1.5), (8.0, 0.1, -0.5), (0.5, 3.0, -0.5),
    (8.0, 1.25, -1.0), (8.0, 1.75, -2.0),
])
def test_correction_hours(spark, hours, adjusted, expected):
    frame = metrics(spark, (1, day("2024-01-08"), 7, hours, 1.0, True, 10.0))
    wanted = frame.select("timesheet_id", F.lit(adjusted).alias("adjusted_hours"))
    got = facts.correction_rows(frame, wanted).head()
    assert got["hours_worked"] == expected and got["revenue_usd"] == expected * 10
    assert got["is_anomaly"] and got["is_correction"] and got["entry_type"] == "correction"
    assert got["original_timesheet_id"] == frame.head()["timesheet_id"] != got["timesheet_id"]


def test_corrections_only_for_worked_originals(spark):
    frame = metrics(
        spark, (1, day("2024-01-08"), None, 0.0, 1.0, False, 0.0), (2, day("2024-01-08"), None, 3.0, 1.0, False, 0.0))
    wanted = frame.select("timesheet_id", F.lit(1.0).alias("adjusted_hours"))
    both = facts.apply_corrections(frame, wanted)
    assert rows(both, "emp_id", "hours_worked", "revenue_usd") == [(1, 0.0, 0.0), (2, -1.0, 0.0), (2, 3.0, 0.0)]
    again = wanted.withColumn("timesheet_id", F.lit("unknown"))
    assert facts.correction_rows(both, again).count() == 0
    assert facts.correction_rows(frame, wanted.withColumn("adjusted_hours", F.lit(None).cast("double"))).count() == 0


def test_lineage(spark):
    frame = metrics(spark, (2, day("2024-01-08"), None, 3.0, 1.0, False, 0.0))
    both = facts.apply_corrections(frame, frame.select("timesheet_id", F.lit(1.0).alias("adjusted_hours")))
    assert rows(facts.correction_lineage(both), "net_hours", "original_found") == [(2.0, True)]
    assert facts.broken_references(both).count() == 0
    orphans = both.filter("is_correction")
    assert rows(facts.correction_lineage(orphans), "net_hours", "original_found") == [(None, False)]
    assert facts.broken_references(orphans).count() == 1


def test_rate_card(spark):
    entries = spark.createDataFrame([
        ("a", "USA", day("2023-05-01"), "Analyst"), ("b", "Qatar", day("2025-05-01"), "MANAGER"),
        ("c", None, day("2030-05-01"), None), ("d", "Atlantis", day("2024-05-01"), "intern"),
    ], "tag string, client_country string, work_date date, designation string")
    assert rows(facts.rate_card(entries), "tag", "hourly_rate_usd") == [
        ("a", 75.0), ("b", 86.0), ("c", 66.15), ("d", 56.7)]
    given = entries.withColumn("base_rate_usd", F.lit(60.0))
    assert rows(facts.rate_card(given), "tag", "hourly_rate_usd")[0] == ("a", 60.0)


def test_salary_bands(spark):
    people = spark.createDataFrame([
        (1, "PAKISTAN", "consultant", 48000.0), (2, "Usa", "SENIOR ANALYST", 19500.01),
        (3, "Atlantis", "consultant", 1.0), (4, "Germany", "intern", 3000.0),
    ], "emp_id long, region string, designation string, local_salary double")
    assert rows(facts.salary_bands(people), "emp_id", "band_min", "band_max", "band_currency", "in_band") == [
        (1, 48000.0, 450000.0, "PKR", True), (2, 5000.0, 19500.0, "USD", False),
        (3, None, None, None, None), (4, 3000.0, 11000.0, "EUR", True)]


def test_non_billable_chance(spark):
    entries = spark.createDataFrame([
        (1, "HR", day("2024-01-01"), 5), (2, "Engineering", day("2024-07-01"), 5), (3, None, day("2024-01-01"), 5),
        (4, "HR", day("2024-01-01"), -1), (5, "Legal", day("2024-12-01"), None),
    ], "emp_id long, department string, work_date date, project_id long")
    got = dict(rows(facts.non_billable_chance(entries), "emp_id", "non_billable_chance"))
    assert got[1] == pytest.approx(0.3 * 0.33) and got[2] == 0.03 and got[3] == pytest.approx(0.25 * 0.33)
    assert got[4] == got[5] == 1.0


def test_projects(spark):
    clients = spark.createDataFrame([(1, "p", "c", "USA")], PROJECTS)
    both = projects.with_bench(clients)
    assert rows(both) == [(-1, "Bench", "Internal", "Internal"), (1, "p", "c", "USA")]
    assert rows(projects.client_projects(both)) == [(1, "USA")]


def test_duplicates(spark):
    entry = (1, day("2024-01-08"), 7, 8.0, 1.0, True, 1.0)
    frame = metrics(spark, entry, entry, entry, (2, *entry[1:]))
    assert rows(keys.duplicate_keys(frame, NATURAL_KEY), "emp_id", "row_count") == [(1, 3)]
    assert rows(keys.duplicate_members(frame, NATURAL_KEY), "emp_id") == [(1,)] * 3
    with pytest.raises(ValueError, match="natural key: emp_id=1"):
        checks.require_unique_facts(frame)
    checks.require_unique_facts(frame.filter("emp_id = 2"))
    checks.require_unique_facts(frame.limit(0))


def test_not_null(spark):
    frame = metrics(spark, (1, day("2024-01-08"), 7, None, 1.0, True, 1.0), (2, day("2024-01-08"), 7, 8.0, 1.0, True, 1.0))
    report = {r["column_name"]: (r["null_count"], r["passed"]) for r in
              checks.null_report(frame, "fact", TIMESHEETS).collect()}
    assert report["hours_worked"] == (1, False) and report["emp_id"] == (0, True)
    assert report["original_timesheet_id"] == (2, True)
    with pytest.raises(ValueError, match="hours_worked"):
        checks.require_not_null(frame, "fact", TIMESHEETS)


def test_high_water_mark(spark):
    frame = metrics(spark, (1, day("2024-01-08"), 7, 8.0, 1.0, True, 1.0))
    assert rows(load.high_water_mark(frame)) == [(day("2024-01-08"), day("2024-01-09"))]
    assert rows(load.high_water_mark(frame.limit(0))) == [(None, day("2023-01-01"))]


def test_batch_id():
    name, now = load.new_batch(NOW)
    assert name.startswith("RUN-20240131-020000-") and len(name) == 28 and now == NOW
