"""Results and plans when one key holds a third of all rows and nothing is broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import keys
from rosterlake.operators.asof import active_project
from rosterlake.plans import facts, gold, silver
from rosterlake.schemas import NATURAL_KEY, SCHEDULE
from tests.conftest import day, plan, rows
from verification.lens import Lens
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WRITES = {"load_append_fact", "fact_partitioned_write", "fact_schema_evolve", "load_audit",
          "incremental_load", "streaming_load", "load_quarantine", "streaming_conflicts",
          "gold_from_views", "daily_run"}


@pytest.fixture
def hot(spark):
    """The lens timesheets, with one employee, project and id on a third of the rows."""
    lens = Lens(spark, FOLDER)
    sheets = lens.timesheets
    one = sheets.filter("timesheet_id = '1-1' OR emp_id = 7").limit(1).drop("load_timestamp", "batch_id")
    copies = one.crossJoin(spark.range(3000)).select(
        *one.columns,
        (F.lit("2030-01-01").cast("timestamp_ntz") + F.expr("INTERVAL 1 SECOND") * F.col("id")).alias("load_timestamp"),
        F.concat(F.lit("RUN-"), F.col("id").cast("string")).alias("batch_id"),
    )
    return lens, sheets.unionByName(copies.select(*sheets.columns))


def test_dedup_of_a_hot_id(hot):
    lens, sheets = hot
    kept = silver.silver_timesheets(sheets)
    plain = silver.silver_timesheets(lens.timesheets)
    assert kept.count() == plain.count()
    assert kept.filter("batch_id = 'RUN-2999'").count() == 1


def test_dedup_limits_groups_before_the_shuffle(hot):
    text = plan(silver.silver_timesheets(hot[1]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange hashpartitioning(timesheet_id") < text.rindex("WindowGroupLimit")


def test_gold_without_broadcast(hot, no_broadcast):
    lens, sheets = hot
    got = gold.gold_from_bronze(sheets, lens.employees, lens.projects, lens.exchange_rates)
    assert "BroadcastHashJoin" not in plan(got)
    shuffled = rows(got, "timesheet_id", "bench_cost_usd", "salary_usd")
    assert len({r[0] for r in shuffled}) == len(shuffled)


def test_gold_is_the_same_with_and_without_broadcast(spark, no_broadcast):
    shuffled = rows(QUERIES["gold_timesheets_enriched"](spark, FOLDER))
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)
    assert rows(QUERIES["gold_timesheets_enriched"](spark, FOLDER)) == shuffled


def test_adaptive_execution_splits_a_hot_project(spark, no_broadcast):
    """The split Spark makes on a cluster, with thresholds small enough for the test."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sheets = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("project_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        projects = spark.range(-1, 500).select(F.col("id").alias("project_id"), F.lit("x").alias("name"))
        joined = sheets.join(projects, "project_id")
        assert joined.groupBy().agg(F.count("payload")).head()[0] == 60000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_lookup_of_a_hot_employee_meets_each_day_once(spark, no_broadcast):
    """Half the probes and intervals belong to one employee."""
    start = day("2024-01-01")
    probes = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 100).cast("long").alias("emp_id"),
        F.date_add(F.lit(start), (F.col("id") % 365).cast("int")).alias("work_date"), "id")
    table = spark.createDataFrame(
        [(e, i, start + dt.timedelta(days=i % 360), start + dt.timedelta(days=i % 360 + 5))
         for i in range(3000) for e in ([0] if i % 2 else [i % 100])], SCHEDULE)
    got = active_project(probes, table)
    assert got.count() == 20000
    text = plan(got)
    assert "Cartesian" not in text and "NestedLoop" not in text
    starts = table.groupBy("emp_id", "start_date").agg(F.max(F.struct("end_date", "project_id")).alias("v"))
    brute = (
        probes.join(starts, "emp_id", "left").filter("start_date <= work_date OR start_date IS NULL")
        .groupBy("id", "work_date").agg(F.max_by("v", "start_date").alias("v"))
        .select("id", F.when(F.col("work_date") <= F.col("v.end_date"), F.col("v.project_id")).alias("p"))
    )
    different = got.join(brute, "id", "left").filter(F.col("project_id") != F.coalesce("p", F.lit(-1)))
    assert different.count() == 0


def test_duplicates_are_counted_before_the_shuffle(hot):
    assert "partial_count" in plan(keys.duplicate_keys(hot[1], NATURAL_KEY))
    members = keys.duplicate_members(hot[1], NATURAL_KEY)
    assert "Window" not in plan(members)
    assert members.count() >= 3001


def test_corrections_without_broadcast(spark, no_broadcast):
    lens = Lens(spark, FOLDER)
    sheets = silver.silver_timesheets(lens.timesheets)
    both = facts.apply_corrections(sheets, lens.adjustments)
    assert both.count() > sheets.count()
    lineage = facts.correction_lineage(both)
    assert lineage.count() == both.filter("is_correction").count()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plans(spark, name):
    """No Python in the plan, no cartesian product, no nested loop."""
    text = plan(QUERIES[name](spark, FOLDER))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_gold_reads_few_columns(spark):
    text = plan(QUERIES["gold_totals"](spark, FOLDER))
    assert "l_extendedprice" not in text and "l_discount" not in text and "o_totalprice" not in text


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["schedule_asof"](spark, FOLDER))
    assert "EqualTo(event_type,signup)" in text
