import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake import session
from rosterlake.plans import calendar, gold, silver
from rosterlake.plans.stored_views import store_views
from rosterlake.schemas import CALENDAR, EMPLOYEES, PROJECTS, TABLES, TIMESHEETS
from rosterlake.sources.tables import lay_out_fact, read_files, read_files_or_empty, read_merged
from tests.conftest import day, plan, rows
from verification.lens import Lens
from tests.test_silver_gold import sheet

PEOPLE = [(1, "a", None, "MANAGER", 1.0, "PKR", "USA", day("2024-01-01")),
          (2, "b", "QA", "Analyst", 2.0, "USD", "UAE", day("2024-01-01"))]


def test_scan_with_schema_and_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "p", "c", "USA")], PROJECTS).write.parquet(path)
    assert rows(read_files(spark, path, PROJECTS, ["client_country", "project_id"])) == [("USA", 1)]


def test_missing_path_and_table_read_empty(spark, lake, tmp_path):
    frame = read_files_or_empty(spark, str(tmp_path / "nowhere"), PROJECTS)
    assert frame.schema == PROJECTS and frame.isEmpty()
    assert lake.read_or_empty("dim_projects").schema == PROJECTS


def test_replace_may_read_its_own_table(spark, lake):
    bounds = calendar.date_bounds(spark, day("2024-01-01"), day("2024-01-10"))
    assert lake.replace(calendar.dim_date(bounds), "dim_date") == 10
    weekend = lake.read("dim_date").filter("is_weekend")
    assert lake.replace(weekend, "dim_date") == 2
    assert lake.read("dim_date").count() == 2
    assert [f.dataType for f in lake.read("dim_date").schema] == [f.dataType for f in CALENDAR]


def test_failed_replace_keeps_the_table(spark, lake):
    lake.replace(spark.createDataFrame(PEOPLE, EMPLOYEES), "dim_employees")
    broken = lake.read("dim_employees").withColumn("local_salary", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        lake.replace(broken, "dim_employees")
    assert lake.read("dim_employees").count() == 2


def test_seed_is_written_once(spark, lake):
    seed = spark.createDataFrame(PEOPLE, EMPLOYEES)
    assert lake.read_or_seed("dim_employees_source", seed).count() == 2
    assert lake.read_or_seed("dim_employees_source", seed.limit(1)).count() == 2


def test_empty_source_takes_the_seed(spark, lake):
    lake.create("dim_employees_source")
    assert lake.read_or_seed("dim_employees_source", spark.createDataFrame(PEOPLE, EMPLOYEES)).count() == 2


def test_append_counts_and_keeps(spark, lake):
    frame = spark.createDataFrame(PEOPLE, EMPLOYEES)
    assert lake.append(frame, "dim_employees") == 2
    assert lake.append(frame.limit(1), "dim_employees") == 1
    assert lake.read("dim_employees").count() == 3


def test_create_keeps_rows_and_recreate_drops_them(spark, lake):
    lake.append(spark.createDataFrame(PEOPLE, EMPLOYEES), "dim_employees")
    lake.create("dim_employees")
    assert lake.read("dim_employees").count() == 2
    lake.recreate("dim_employees")
    assert lake.read("dim_employees").count() == 0
    lake.drop("dim_employees")
    lake.drop("dim_employees")
    assert not lake.exists("dim_employees")


def test_all_tables_can_be_created(lake):
    for table, schema in TABLES.items():
        lake.recreate(table)
        assert sorted(lake.read(table).columns) == sorted(schema.names)
        assert lake.read(table).isEmpty()


@pytest.mark.parametrize("tasks", [None, 3])
def test_fact_is_partitioned_and_pruned(spark, lake, tasks):
    lake.write_tasks = tasks
    sheets = [sheet(f"t{i}", emp=i % 5, work=f"2024-01-{i % 28 + 1:02d}") for i in range(100)]
    assert lake.append(spark.createDataFrame(sheets, TIMESHEETS), "fact_timesheets") == 100
    assert lake.partition_days("fact_timesheets").count() == 28
    one = lake.read("fact_timesheets").filter(F.col("work_date") == F.lit(day("2024-01-05")))
    assert one.count() == 4
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(work_date" in text
    assert all("work_date=2024-01-05" in f for f in one.inputFiles()) or "PartitionCount: 1" in text


def test_layout_splits_one_day(spark):
    """All rows on one day, employee and project still spread over the tasks."""
    sheets = spark.createDataFrame([sheet(f"t{i:04d}") for i in range(1000)], TIMESHEETS)
    sizes = lay_out_fact(sheets, 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(s["count"] for s in sizes) < 600
    assert "REBALANCE_PARTITIONS_BY_COL" in lay_out_fact(sheets)._jdf.queryExecution().executedPlan().toString()


def test_evolution_is_additive(spark, lake):
    added = ["created_at", "revenue_usd", "is_anomaly", "is_weekend_work"]
    old = T.StructType([f for f in TIMESHEETS.fields if f.name not in added])
    lake.create("fact_timesheets", old)
    lake.append(spark.createDataFrame([sheet("old")], TIMESHEETS), "fact_timesheets")
    assert lake.add_missing_columns("fact_timesheets") == added
    assert lake.add_missing_columns("fact_timesheets") == []
    lake.append(spark.createDataFrame([sheet("new")], TIMESHEETS), "fact_timesheets")
    assert rows(lake.read("fact_timesheets"), "timesheet_id", "revenue_usd", "is_anomaly") == [
        ("new", 0.0, False), ("old", None, None)]


def test_work_folder_follows_the_cluster_setting(spark, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Context:
        master = "spark://somewhere"

    class Session:
        sparkContext = Context()

        def __init__(self, value):
            self.conf = Conf(value)

    one, two = (session.work_folder(Session("/shared/x/")) for _ in range(2))
    assert one.startswith("/shared/x/rosterlake-") and one != two
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_folder(Session(None))


SMALL = "/root/testdata/sf0.001"


def test_a_clustered_fact_is_deduplicated_without_a_shuffle(spark, lake, no_broadcast):
    lens = Lens(spark, SMALL)
    for part in (lens.timesheets.filter("emp_id < 60"), lens.timesheets.filter("emp_id >= 60")):
        lake.append_clustered(part, "fact_by_id", ["timesheet_id"], ["emp_id", "project_id"], 4)
    stored = lake.read("fact_by_id")
    assert len(stored.inputFiles()) == 8
    latest = silver.silver_timesheets(stored)
    assert "Exchange" not in plan(latest) and "Exchange" in plan(silver.silver_timesheets(lens.timesheets))
    assert rows(latest, "timesheet_id", "hours_worked") == rows(
        silver.silver_timesheets(lens.timesheets), "timesheet_id", "hours_worked")
    # versions joined with corrections by id: no exchange of the fact either
    joined = stored.select("timesheet_id", "hours_worked").join(latest.select("timesheet_id"), "timesheet_id")
    assert "Exchange" not in plan(joined)


def test_sorted_buckets_skip_row_groups_by_employee(spark, lake):
    lens = Lens(spark, SMALL)
    spark.conf.set("parquet.block.size", "16384")
    try:
        frame = lens.timesheets.select("timesheet_id", "emp_id", "project_id", "work_date")
        lake.append_clustered(frame, "fact_by_id", ["timesheet_id"], ["emp_id", "project_id"], 2)
    finally:
        spark.conf.unset("parquet.block.size")
    for name in lake.read("fact_by_id").inputFiles():
        held = pq.ParquetFile(name.removeprefix("file://"))
        column = held.schema.names.index("emp_id")
        spans = [held.metadata.row_group(i).column(column).statistics for i in range(held.num_row_groups)]
        assert all(a.max <= b.min for a, b in zip(spans, spans[1:]))
    assert "emp_id" in plan(lake.read("fact_by_id").filter("emp_id = 7")).split("PushedFilters")[1]


def test_unused_folders_go_and_live_ones_stay(spark, lake):
    people = spark.createDataFrame(PEOPLE, EMPLOYEES)
    lake.replace(people, "dim_employees")
    lake.replace(people.limit(1), "dim_employees")
    lake.append(people, "dim_employees_source")
    lake.drop("dim_employees_source")
    broken = people.withColumn("local_salary", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        lake.replace(broken, "dim_employees")
    other = Path(lake.root, "dim_employees", "notes")
    other.mkdir()
    count = sum(1 for _ in Path(lake.root).glob("*/*"))
    assert lake.remove_unused() == 0
    removed = lake.remove_unused(dt.timedelta(0), dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=5))
    assert removed == count - 2 >= 2
    assert other.is_dir() and lake.read("dim_employees").count() == 1
    assert lake.remove_unused(dt.timedelta(0)) == 0


def test_files_are_bounded_and_days_compacted(spark, lake):
    days = [sheet(f"t{i}", emp=i, work=f"2024-01-0{1 + i % 2}") for i in range(40)]
    frame = spark.createDataFrame(days, TIMESHEETS)
    lake.max_file_rows = 7
    for part in (frame.filter("emp_id < 20"), frame.filter("emp_id >= 20")):
        lake.append(part, "fact_timesheets")
    before = rows(lake.read("fact_timesheets"))

    def sizes():
        return [pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows
                for f in lake.read("fact_timesheets").inputFiles()]

    assert max(sizes()) <= 7 and len(sizes()) == 8
    assert lake.compact_days("fact_timesheets", 10) == [day("2024-01-01"), day("2024-01-02")]
    assert sorted(sizes()) == [10, 10, 10, 10] and rows(lake.read("fact_timesheets")) == before
    assert lake.compact_days("fact_timesheets", 10) == []
    # a run that died before it had replaced the days left their rows staged
    lake.read("fact_timesheets").write.saveAsTable(lake.name("staging_compact_fact_timesheets"))
    lake.compact_days("fact_timesheets", 100)
    assert sorted(sizes()) == [20, 20] and rows(lake.read("fact_timesheets")) == before
    assert lake.tables("staging") == []


def test_files_of_two_schemas_read_as_one(spark, tmp_path):
    frame = spark.createDataFrame([(1, "p", "c", "USA"), (2, "q", "d", "UAE")], PROJECTS)
    frame.filter("project_id = 1").drop("client_country").write.parquet(str(tmp_path / "x/a=1"))
    frame.filter("project_id = 2").withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "x/a=2"))
    wide = T.StructType([*PROJECTS.fields, T.StructField("later", T.DoubleType())])
    merged = read_merged(spark, str(tmp_path / "x"), wide)
    assert merged.columns == [f.name for f in wide.fields]
    assert rows(merged) == [(1, "p", "c", None, None), (2, "q", "d", "UAE", None)]


def test_stored_views_equal_the_plans_in_a_new_session(spark, lake):
    lens = Lens(spark, SMALL)
    names = store_views(lake)
    for table in ("dim_employees", "dim_projects", "dim_exchange_rates"):
        lake.replace(getattr(lens, table.removeprefix("dim_")), table)
    lake.append(lens.timesheets.filter("emp_id % 10 = 3").withColumn("work_date", F.trunc("work_date", "year")),
                "fact_timesheets")
    store_views(lake)
    facts = lake.read("fact_timesheets")
    built = {
        "silver_employees": silver.silver_employees(lens.employees),
        "silver_projects": silver.silver_projects(lens.projects),
        "silver_timesheets": silver.silver_timesheets(facts, silver.TIMESHEET_COLUMNS),
        "silver_exchange_rates": silver.silver_exchange_rates(lens.exchange_rates),
    }
    built["gold_employees"] = gold.gold_employees(built["silver_employees"], built["silver_exchange_rates"])
    built["gold_timesheets_enriched"] = gold.gold_from_bronze(
        facts, lens.employees, lens.projects, lens.exchange_rates)
    session_two = spark.newSession()
    assert sorted(names) == sorted(built)
    for name, frame in built.items():
        seen = session_two.table(lake.name(name))
        assert seen.columns == frame.columns and seen.count() > 0
        assert rows(seen) == rows(frame), name
