import datetime as dt
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rosterlake.plans import load
from rosterlake.plans.load import FACT, QUARANTINE, Inputs, load_increment
from rosterlake.schemas import SCHEDULE
from rosterlake.plans.facts import fact_metrics
from rosterlake.streaming.entries import decide, load_entries
from rosterlake.operators.checks import require_unstored_facts, stored_duplicates, with_reason
from rosterlake.operators.keys import stored_on_days
from rosterlake.streaming.entries import read_entries
from tests.conftest import day, plan, rows
from verification.lens import Lens

DAYS = "emp_id long, work_date date"
MONDAY = day("2024-01-01")


def plus(days):
    return MONDAY + dt.timedelta(days=days)


@pytest.fixture
def inputs(spark):
    """Two employees over two weeks: the second joins on day 3."""
    entries = [(e, plus(d), 7.0, 0.8, True, 50.0) for e in (1, 2) for d in range(14)]
    entries += [(1, plus(21), 99.0, 1.0, True, 50.0), (2, plus(21), 8.0, 1.0, True, 50.0)]
    return Inputs(
        employees=spark.createDataFrame([(1, day("2020-01-01")), (2, plus(3))], "emp_id long, join_date date"),
        schedule=spark.createDataFrame([(1, 7, plus(0), plus(30)), (2, 8, plus(8), plus(30))], SCHEDULE),
        entries=spark.createDataFrame(
            [(1, plus(22), 8.0, 1.0, True, 50.0)] + entries,
            "emp_id long, work_date date, base_hours double, allocation_pct double, "
            "is_billable boolean, hourly_rate_usd double"),
        absences=spark.createDataFrame([(1, plus(1))], DAYS),
        weekend_work=spark.createDataFrame([(1, plus(5))], DAYS),
        adjustments=spark.createDataFrame(
            [(1, plus(2), 1.0), (1, plus(1), 1.0), (1, plus(9), 2.0)],
            "emp_id long, work_date date, adjusted_hours double"),
    )


def loaded(lake, *columns):
    return rows(lake.read(FACT), *(columns or ("emp_id", "work_date", "entry_type", "hours_worked", "project_id")))


def test_loads_meet_and_do_not_repeat(lake, inputs):
    first = load_increment(lake, inputs, plus(6))
    assert (first.first, first.last) == (day("2023-01-01"), plus(6))
    # employee 1: Monday to Friday but the absence, the listed Saturday, one correction;
    # employee 2: Thursday and Friday, on the bench
    assert loaded(lake) == sorted([
        *[(1, plus(d), "original", 5.5, 7) for d in (0, 2, 3, 4, 5)],
        (1, plus(2), "correction", -1.0, 7),
        *[(2, plus(d), "original", 7.0, -1) for d in (3, 4)],
    ], key=repr)
    # set aside: employee 1 absent and on Sunday; employee 2 before joining and on the weekend
    assert first.loaded == 8 and first.quarantined == 2 + 3 + 2

    again = load_increment(lake, inputs, plus(6))
    # the last loaded day is the Saturday, so Sunday is looked at once more
    assert again.loaded == 0 and again.first == plus(6)
    assert len(loaded(lake)) == 8

    second = load_increment(lake, inputs, plus(13))
    assert second.loaded == 5 + 1 + 5
    assert load_increment(lake, inputs, plus(13)).loaded == 0
    assert lake.read(FACT).select("batch_id").distinct().count() == 2


def test_one_load_equals_two(lake, inputs):
    load_increment(lake, inputs, plus(6))
    load_increment(lake, inputs, plus(13))
    two = loaded(lake, "timesheet_id", "hours_worked", "revenue_usd")
    lake.recreate(FACT)
    load_increment(lake, inputs, plus(13))
    assert loaded(lake, "timesheet_id", "hours_worked", "revenue_usd") == two


def test_out_of_range_is_set_aside(lake, inputs):
    assert load_increment(lake, inputs, plus(21)).quarantined == 12
    assert rows(lake.read(QUARANTINE).filter("reason LIKE '%range'"), "emp_id", "work_date", "reason") == [
        (1, plus(21), "hours out of range")]
    assert (1, plus(21)) not in loaded(lake, "emp_id", "work_date")
    assert lake.tables("staging") == []


def test_duplicate_entry_loads_nothing(lake, inputs):
    load_increment(lake, inputs, plus(2))
    before = loaded(lake)
    inputs.entries = inputs.entries.unionByName(inputs.entries.filter(F.col("work_date") == F.lit(plus(4))))
    with pytest.raises(ValueError, match="natural key"):
        load_increment(lake, inputs, plus(6))
    assert loaded(lake) == before


def test_null_in_a_required_column_loads_nothing(lake, inputs):
    inputs.entries = inputs.entries.withColumn("hourly_rate_usd", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="Null in required columns"):
        load_increment(lake, inputs, plus(6))
    assert lake.read(FACT).count() == 0


def test_a_lost_driver_is_made_good(lake, inputs):
    """The driver dies after it has written one day and half of another."""
    load_increment(lake, inputs, plus(13))
    whole = loaded(lake, "timesheet_id", "hours_worked")
    lake.recreate(FACT)
    lake.create(FACT)
    judged = load.judged_facts(inputs, day("2023-01-01"), plus(13), "RUN-lost", dt.datetime(2024, 1, 31))
    load.stage(lake, judged, load.STAGING + "run_lost")
    part = judged.filter("reason IS NULL AND emp_id = 1").filter(F.col("work_date") <= F.lit(plus(9)))
    lake.append(part, FACT)
    outcome = load_increment(lake, inputs, plus(13))
    assert loaded(lake, "timesheet_id", "hours_worked") == whole
    assert outcome.loaded == len(whole) - part.count()
    assert lake.tables("staging") == []


def test_rows_lie_in_day_folders(lake, inputs):
    load_increment(lake, inputs, plus(6))
    files = lake.read(FACT).inputFiles()
    assert files and all("work_date=" in f for f in files)


def test_stream_of_entries(spark, lake, inputs, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    entries = inputs.entries.withColumn("project_id", F.lit(7).cast("long"))
    entries.filter(F.col("work_date") < F.lit(plus(5))).coalesce(1).write.parquet(source)

    def run():
        stream = spark.readStream.schema(entries.schema).parquet(source)
        load_entries(lake, stream, checkpoint).awaitTermination(120)

    run()
    assert len(loaded(lake)) == 10
    run()
    assert len(loaded(lake)) == 10
    # the next files bring one known row, new days and one row out of range
    entries.filter(F.col("work_date") >= F.lit(plus(4))).coalesce(1).write.mode("append").parquet(source)
    run()
    assert lake.read(FACT).groupBy("timesheet_id").count().filter("count > 1").count() == 0
    assert len(loaded(lake)) == 28 + 2
    assert rows(lake.read(QUARANTINE), "emp_id", "reason") == [(1, "hours out of range")]


def test_stream_replay_appends_nothing(spark, lake, inputs, tmp_path):
    """The same files under a new checkpoint, as after a lost one."""
    source = str(tmp_path / "in")
    entries = inputs.entries.withColumn("project_id", F.lit(7).cast("long")).filter("base_hours <= 8")
    entries.coalesce(1).write.parquet(source)
    for run in ("a", "b"):
        stream = spark.readStream.schema(entries.schema).parquet(source)
        load_entries(lake, stream, str(tmp_path / run)).awaitTermination(120)
    assert len(loaded(lake)) == entries.count()


def test_every_entry_is_loaded_or_set_aside_once(lake, inputs):
    """Accepted and set aside are the entries of the days, over three runs that overlap."""
    more = [(9, plus(2), 7.0, 0.8, True, 50.0), (1, plus(3), 7.0, 0.8, True, 50.0), (1, plus(3), 7.0, 0.8, True, 50.0),
            (1, plus(4), 6.0, 0.8, True, 50.0), (2, plus(9), 7.0, 1.5, True, 50.0), (2, plus(9), None, 0.8, True, 50.0)]
    inputs.entries = inputs.entries.unionByName(inputs.entries.sparkSession.createDataFrame(more, inputs.entries.schema))
    inputs.adjustments = inputs.adjustments.limit(0)
    for last in (plus(6), plus(6), plus(22)):
        load_increment(lake, inputs, last, conflicts="set aside")
    asked = inputs.entries.filter(F.col("work_date") <= F.lit(plus(22)))
    assert lake.read(FACT).count() + lake.read(QUARANTINE).count() == asked.count()
    told = lake.read(QUARANTINE).groupBy("reason").count()
    assert rows(told) == [("absent", 1), ("allocation out of range", 1), ("before joining", 3), ("conflict", 2),
                          ("hours out of range", 2), ("repeat", 2), ("unknown employee", 1), ("weekend not listed", 7)]
    assert (1, plus(4), "original") not in loaded(lake, "emp_id", "work_date", "entry_type")
    assert (1, plus(3), "original") in loaded(lake, "emp_id", "work_date", "entry_type")


def test_another_bad_value_leaves_a_trace(lake, inputs):
    """A rejected entry comes again, with a value that is out of range as well."""
    inputs.entries = inputs.entries.filter(F.col("work_date") == F.lit(plus(21))).filter("emp_id = 1")
    for hours in (99.0, 99.0, 77.0):
        inputs.entries = inputs.entries.withColumn("base_hours", F.lit(hours))
        load_increment(lake, inputs, plus(21))
    assert rows(lake.read(QUARANTINE), "hours_worked") == [(77.0,), (99.0,)]


def test_keys_in_the_table_are_found_on_their_days_only(lake, inputs):
    load_increment(lake, inputs, plus(13))
    stored = lake.read(FACT)
    batch = stored.filter(F.col("work_date").isin(plus(2), plus(11))).withColumn("load_timestamp", F.current_timestamp())
    new = batch.withColumn("emp_id", F.col("emp_id") + 100)
    assert rows(stored_duplicates(batch.unionByName(new), stored), "timesheet_id") == rows(batch, "timesheet_id")
    with pytest.raises(ValueError, match="in the table already"):
        require_unstored_facts(batch, stored)
    require_unstored_facts(new, stored)
    # Of the ten days between, only the two are opened.
    held = stored_on_days(batch, stored, ["timesheet_id"])
    assert "dynamicpruning" in plan(held)
    assert {r["work_date"] for r in held.collect()} == {plus(2), plus(11)}


def entry_files(entries, folder):
    """Each delivery as a file of its own, in order."""
    deliveries = [
        entries.filter("base_hours <= 8"),
        # one says something else, one repeats, one is out of range
        entries.filter((F.col("emp_id") == 1) & (F.col("work_date") == F.lit(plus(0)))).withColumn("base_hours", F.lit(2.0)),
        entries.filter(F.col("work_date") == F.lit(plus(2))),
        entries.filter("base_hours > 8"),
        # the same contradiction and the same bad value again, and a third version
        entries.filter((F.col("emp_id") == 1) & (F.col("work_date") == F.lit(plus(0)))).withColumn("base_hours", F.lit(2.0)),
        entries.filter("base_hours > 8"),
        entries.filter((F.col("emp_id") == 1) & (F.col("work_date") == F.lit(plus(0)))).withColumn("base_hours", F.lit(3.0)),
    ]
    dated = set()
    for number, part in enumerate(deliveries):
        part.coalesce(1).write.mode("append").parquet(folder)
        for written in set(Path(folder).glob("part-*.parquet")) - dated:
            os.utime(written, (1.7e9 + number, 1.7e9 + number))
            dated.add(written)


def test_stream_does_not_depend_on_files_per_trigger(spark, lake, inputs, tmp_path):
    source = str(tmp_path / "in")
    entries = inputs.entries.withColumn("project_id", F.lit(7).cast("long"))
    entry_files(entries, source)
    results = []
    for files in (1, 100):
        lake.recreate(FACT)
        lake.drop(QUARANTINE)
        stream = read_entries(spark, source, entries.schema, files)
        load_entries(lake, stream, str(tmp_path / f"checkpoint{files}")).awaitTermination(300)
        results.append([rows(lake.read(table).drop("batch_id", "load_timestamp")) for table in (FACT, QUARANTINE)])
        assert lake.tables("staging") == []
    assert results[0] == results[1]
    assert rows(lake.read(QUARANTINE), "emp_id", "hours_worked", "reason") == [
        (1, 1.5, "conflict"), (1, 2.5, "conflict"), (1, 99.0, "hours out of range")]
    assert len(loaded(lake)) == entries.filter("base_hours <= 8").count()


def test_stream_replays_a_lost_micro_batch(spark, lake, inputs, tmp_path, monkeypatch):
    """The driver dies after the facts are stored and before the micro-batch is committed."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    entries = inputs.entries.withColumn("project_id", F.lit(7).cast("long"))
    entry_files(entries, source)
    drop = lake.drop

    def lost(table):
        if table.startswith("staging_stream"):
            raise RuntimeError("lost")
        drop(table)

    monkeypatch.setattr(lake, "drop", lost)
    with pytest.raises(Exception, match="lost"):
        load_entries(lake, read_entries(spark, source, entries.schema), checkpoint).awaitTermination(300)
    first = [rows(lake.read(table), "timesheet_id", "hours_worked") for table in (FACT, QUARANTINE)]
    assert lake.tables("staging") != []
    monkeypatch.setattr(lake, "drop", drop)
    load_entries(lake, read_entries(spark, source, entries.schema), checkpoint).awaitTermination(300)
    assert [rows(lake.read(table), "timesheet_id", "hours_worked") for table in (FACT, QUARANTINE)] == first
    assert lake.tables("staging") == []


def shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (held.apply(i).getName() for i in range(held.size())) if name.startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files since then; Spark removes them a moment after the statement."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def repeated(inputs):
    """The entries with repeats, conflicts and a null employee, as set aside."""
    more = [(1, plus(3), 7.0, 0.8, True, 50.0), (1, plus(3), 7.0, 0.8, True, 50.0), (1, plus(4), 6.0, 0.8, True, 50.0),
            (None, plus(4), 6.0, 0.8, True, 50.0), (None, plus(4), 6.0, 0.8, True, 50.0), (9, plus(2), 7.0, 0.8, True, 50.0)]
    return inputs.entries.unionByName(inputs.entries.sparkSession.createDataFrame(more, inputs.entries.schema))


def test_a_load_in_parts_equals_one_at_once(spark, lake, inputs, monkeypatch):
    inputs.entries = repeated(inputs)
    results = []
    for rows_of_a_part in (1000, 4):
        monkeypatch.setattr(load, "PART_ROWS", rows_of_a_part)
        lake.recreate(FACT)
        lake.drop(QUARANTINE)
        outcomes = [load_increment(lake, inputs, plus(d), conflicts="set aside") for d in (6, 6, 22)]
        results.append([[(o.loaded, o.quarantined) for o in outcomes],
                        *[rows(lake.read(t).drop("batch_id", "load_timestamp")) for t in (FACT, QUARANTINE)]])
        assert lake.tables("staging") == lake.tables("unfinished") == []
    assert results[0] == results[1]
    corrections = lake.read(FACT).filter("is_correction")
    originals = lake.read(FACT).filter("NOT is_correction")
    assert corrections.count() == 2 and corrections.join(
        originals.select(F.col("timesheet_id").alias("original_timesheet_id")), "original_timesheet_id").count() == 2


def test_staging_and_appends_leave_no_shuffle_files(spark, lake, inputs):
    inputs.entries = repeated(inputs)
    judged = load.judged_facts(inputs, day("2023-01-01"), plus(22), "RUN-1", dt.datetime(2024, 1, 31))
    before = shuffle_files(spark)
    load.stage(lake, load.settle(judged), "staging_load_one")
    lake.append(load.complete(lake.read("staging_load_one").filter("reason IS NULL")), FACT)
    assert left_behind(spark, before) == set()
    assert lake.read(FACT).count() > 10


def test_what_a_load_stages_and_shuffles_holds_no_ids(spark, lake, inputs):
    judged = load.judged_facts(inputs, day("2023-01-01"), plus(22), "RUN-1", dt.datetime(2024, 1, 31))
    load.stage(lake, judged, "staging_load_one")
    staged = lake.read("staging_load_one")
    assert "timesheet_id" not in staged.columns
    assert rows(load.complete(staged, ["reason"])) == rows(judged)
    exchanges = [line for line in plan(load.settle(judged)).splitlines() if "Exchange" in line]
    assert exchanges and not any("timesheet_id" in line or "revenue_usd" in line for line in exchanges)


def test_an_unfinished_staging_table_is_no_lost_load(lake, inputs):
    """The driver dies between two parts: what is staged is not whole, so it is computed again."""
    judged = load.judged_facts(inputs, day("2023-01-01"), plus(22), "RUN-lost", dt.datetime(2024, 1, 31))
    load.stage(lake, judged.filter("emp_id = 1"), load.UNFINISHED + load.STAGING + "run_lost")
    load_increment(lake, inputs, plus(22))
    assert {r[0] for r in loaded(lake, "emp_id")} == {1, 2}
    assert lake.tables("staging") == lake.tables("unfinished") == []
    assert lake.read(FACT).select("batch_id").distinct().count() == 1


def test_a_stream_in_parts_equals_one_at_once(spark, lake, inputs, tmp_path, monkeypatch):
    source = str(tmp_path / "in")
    entries = inputs.entries.withColumn("project_id", F.lit(7).cast("long"))
    entry_files(entries, source)
    results = []
    for rows_of_a_part in (1000, 4):
        monkeypatch.setattr(load, "PART_ROWS", rows_of_a_part)
        lake.recreate(FACT)
        lake.drop(QUARANTINE)
        before = shuffle_files(spark)
        stream = read_entries(spark, source, entries.schema, 3)
        load_entries(lake, stream, str(tmp_path / f"checkpoint{rows_of_a_part}")).awaitTermination(300)
        assert left_behind(spark, before) == set()
        results.append([rows(lake.read(table).drop("batch_id", "load_timestamp")) for table in (FACT, QUARANTINE)])
        assert lake.tables("staging") == lake.tables("unfinished") == []
    assert results[0] == results[1]
    assert rows(lake.read(QUARANTINE), "emp_id", "hours_worked", "reason") == [
        (1, 1.5, "conflict"), (1, 2.5, "conflict"), (1, 99.0, "hours out of range")]


def test_a_stream_without_employee_or_day(spark, lake, tmp_path):
    """A null employee has an id too, so its rows repeat and contradict as others do."""
    kind = ("emp_id long, work_date date, project_id long, base_hours double, allocation_pct double, is_billable boolean, "
            "hourly_rate_usd double, arrival long")
    lines = [(None, plus(1), 7, 8.0, 1.0, True, 50.0, 1), (None, plus(1), 7, 8.0, 1.0, True, 50.0, 2),
             (None, plus(1), 7, 4.0, 1.0, True, 50.0, 3), (5, plus(1), 7, 4.0, 1.0, True, 50.0, 4),
             (5, None, 7, 90.0, 1.0, True, 50.0, 5), (5, None, 7, 90.0, 1.0, True, 50.0, 6)]
    source = str(tmp_path / "in")
    spark.createDataFrame(lines, kind).coalesce(1).write.parquet(source)
    for run in ("a", "b"):
        stream = spark.readStream.schema(kind).parquet(source)
        load_entries(lake, stream, str(tmp_path / run)).awaitTermination(120)
        assert loaded(lake, "emp_id", "work_date", "hours_worked") == [(5, plus(1), 4.0), (None, plus(1), 8.0)]
        assert rows(lake.read(QUARANTINE), "emp_id", "work_date", "hours_worked", "reason") == [
            (5, None, 90.0, "hours out of range"), (None, plus(1), 4.0, "conflict")]


def test_entries_of_lines_joined_once_are_the_same(spark, tmp_path):
    kept = Lens(spark, "/root/testdata/sf0.001")
    once = kept.joined_once(str(tmp_path / "raw"))
    for name in ("daily_entries", "absences", "weekend_work", "daily_adjustments"):
        got = getattr(once, name)
        assert got.schema == getattr(kept, name).schema
        assert rows(got) == rows(getattr(kept, name))
        assert "orders.parquet" not in plan(got)


def test_a_stream_shuffles_no_ids(lake, inputs):
    lake.create(FACT)
    entries = inputs.entries.withColumn("project_id", F.lit(7).cast("long"))
    judged = with_reason(fact_metrics(entries, "RUN-1", dt.datetime(2024, 1, 31), keep=[])).withColumn(
        "arrival", F.monotonically_increasing_id())
    decided = decide(judged, lake.read(FACT))
    assert set(decided.columns) == {*lake.read(FACT).columns, "reason"}
    told = [line for line in plan(decided).splitlines() if "Exchange hashpartitioning" in line]
    assert told and not any("timesheet_id" in line or "revenue_usd" in line for line in told)
