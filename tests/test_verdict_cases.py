"""Bad data and pruning: sums that show it, lookups that keep rows, loads that repeat nothing."""

import math

from pyspark.sql import functions as F

from rosterlake.functions.numbers import exact_avg, money_sum
from rosterlake.functions.text import trim_all
from rosterlake.operators.asof import active_project
from rosterlake.operators.keys import duplicate_members
from rosterlake.plans import silver


def total(spark, values, function):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    return frame.agg(function(F.col("x")).alias("y")).head()["y"]


def test_sums_show_what_does_not_fit(spark):
    assert math.isnan(total(spark, [math.nan, 1.0], exact_avg))
    assert math.isnan(total(spark, [math.nan, 1.0], money_sum))
    assert total(spark, [math.inf, 1.0], money_sum) == math.inf
    assert total(spark, [1e18, 1.0], money_sum) == 1e18
    assert total(spark, [1e17, 1.0], money_sum) == 1e17
    assert total(spark, [0.004] * 3, money_sum) == 0.01
    assert total(spark, [None, 2.0], exact_avg) == 2.0
    assert total(spark, [], money_sum) is None


def test_lookup_keeps_probes_without_key(spark):
    probes = spark.createDataFrame(
        [(None, "2024-01-01"), (1, None), (1, "2024-01-01")], "emp_id bigint, work_date string"
    ).withColumn("work_date", F.to_date("work_date"))
    schedule = spark.sql("SELECT 1L AS emp_id, 7L AS project_id, DATE'2023-01-01' AS start_date, "
                         "DATE'2025-01-01' AS end_date")
    found = active_project(probes, schedule).collect()
    assert sorted(r["project_id"] for r in found) == [-1, -1, 7]


def test_null_keys_are_duplicates(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k bigint, v bigint")
    assert sorted(r["v"] for r in duplicate_members(frame, ["k"]).collect()) == [1, 2]


def test_trim_takes_all_white_space(spark):
    frame = spark.createDataFrame([(" \t a 　b\x85\n",)], "s string")
    assert frame.select(trim_all(F.col("s")).alias("s")).head()["s"] == "a 　b"


def test_a_day_of_the_latest_versions_reads_its_partition(spark, tmp_path):
    folder = str(tmp_path / "fact")
    spark.sql("SELECT string(id) AS timesheet_id, timestamp'2024-01-01' AS load_timestamp, "
              "'b' AS batch_id, date_add(DATE'2024-01-01', int(id % 5)) AS work_date FROM range(50)"
              ).write.partitionBy("work_date").parquet(folder)
    day = silver.silver_timesheets(spark.read.parquet(folder), prune_key="work_date").filter(
        "work_date = DATE'2024-01-03'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(work_date" in plan
    assert day.count() == 10
