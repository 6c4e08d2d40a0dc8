"""One query per operator, over the whole lens tables of a data folder."""

import dataclasses
import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.operators import checks, keys
from rosterlake.operators.asof import active_project
from rosterlake.plans import calendar, facts, fx, gold, load, profile, schedule, silver
from rosterlake.plans import projects as project_plans
from rosterlake.plans.daily import Sources
from rosterlake.plans.daily import daily_run as run_day
from rosterlake.plans.stored_views import store_views
from rosterlake.schemas import EMPLOYEES, EXCHANGE_RATES, FX_KEY, NATURAL_KEY, PROJECTS
from rosterlake.schemas import TABLES, TIMESHEETS
from rosterlake.session import COMPRESSION, discard, task_count, tidy, work_folder
from rosterlake.sources import fx_documents
from rosterlake.sources.tables import Lake, read_files
from rosterlake.streaming.entries import load_entries, read_entries
from verification.lens import Lens

OVER_LENS = {}
QUERIES = {}

BATCH = "RUN-20020101-020000-00000001"
LOADED_AT = dt.datetime(2002, 1, 1, 2, 0, 0)
SPLIT_DAY = "1998-07-01"


def query(function):
    OVER_LENS[function.__name__] = function
    QUERIES[function.__name__] = lambda spark, folder: function(Lens(spark, folder))
    return function


def new_lake(spark):
    """An empty lake; the lens spreads its rows over thousands of small days."""
    return Lake(spark, f"rosterlake_{uuid.uuid4().hex[:12]}", work_folder(spark),
                write_tasks=task_count(spark))


def wall_clock(frame):
    """Instants as the wall clock of the session, as the other engine shows them."""
    return frame.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in frame.schema.fields
    ])


def fact_bounds(lens):
    return lens.timesheets.agg(
        F.min("work_date").alias("first_day"), F.max("work_date").alias("last_day")
    )


def silver_facts(lens):
    return silver.silver_timesheets(lens.timesheets)


def enriched(lens):
    return gold.gold_from_bronze(
        lens.timesheets, lens.employees, lens.projects, lens.exchange_rates
    )


# --- scans, sources, sinks ----------------------------------------------------

@query
def scan_projects(lens):
    path = work_folder(lens.spark)
    lens.projects.write.parquet(path)
    return read_files(lens.spark, path, PROJECTS,
                      ["project_id", "project_name", "client_name", "client_country"])


@query
def seed_or_reuse_employees(lens):
    lake = new_lake(lens.spark)
    lake.read_or_seed("dim_employees_source", lens.employees)
    other = lens.employees.withColumn("name", F.lit("another seed"))
    lake.replace(lake.read_or_seed("dim_employees_source", other), "dim_employees")
    return lake.read("dim_employees")


@query
def fx_from_json(lens):
    path = work_folder(lens.spark)
    document = F.format_string('{"event_id": %d, "rates": %s}', "event_id", "props")
    lens.source("events").select(document).write.text(path)
    shape = T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("rates", T.MapType(T.StringType(), T.DoubleType())),
    ])
    return fx_documents.explode_rates(lens.spark.read.schema(shape).json(path), "event_id")


@query
def fx_existing_keys(lens):
    lake = new_lake(lens.spark)
    absent = lake.read_or_empty("dim_exchange_rates").select(*FX_KEY)
    lake.append(lens.exchange_rates, "dim_exchange_rates")
    return absent.unionByName(lake.read_or_empty("dim_exchange_rates").select(*FX_KEY))


@query
def load_replace_calendar(lens):
    lake = new_lake(lens.spark)
    lake.replace(calendar.dim_date(fact_bounds(lens)), "dim_date")
    lake.replace(lake.read("dim_date"), "dim_date")
    return lake.read("dim_date")


@query
def load_append_fact(lens):
    lake = new_lake(lens.spark)
    earlier = F.col("work_date") < F.lit(SPLIT_DAY).cast("date")
    for part in (lens.timesheets.filter(earlier), lens.timesheets.filter(~earlier)):
        lake.append(part, "fact_timesheets")
    return wall_clock(lake.read("fact_timesheets"))


@query
def fact_partitioned_write(lens):
    lake = new_lake(lens.spark)
    lake.append(lens.timesheets, "fact_timesheets")
    later = lake.read("fact_timesheets").filter(F.col("work_date") >= F.lit(SPLIT_DAY).cast("date"))
    return later.groupBy("work_date", "project_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("hours_worked").alias("hours_worked"),
    )


@query
def fact_schema_evolve(lens):
    added = ["created_at", "revenue_usd", "is_anomaly", "is_weekend_work"]
    old = T.StructType([f for f in TIMESHEETS.fields if f.name not in added])
    lake = new_lake(lens.spark)
    lake.create("fact_timesheets", old)
    day = F.lit(SPLIT_DAY).cast("date")
    lake.append(lens.timesheets.filter(F.col("work_date") < day), "fact_timesheets")
    lake.add_missing_columns("fact_timesheets")
    lake.append(lens.timesheets.filter(F.col("work_date") >= day), "fact_timesheets")
    return wall_clock(
        lake.read("fact_timesheets", ["timesheet_id", "load_timestamp", "hours_worked", *added])
    )


@query
def empty_tables(lens):
    """Create or replace the seven tables, then load all but the fact, whose load has
    queries of its own: rows before and after."""
    lake = new_lake(lens.spark)
    content = {
        "dim_employees_source": lens.employees,
        "dim_employees": lens.employees,
        "dim_projects_source": lens.projects,
        "dim_projects": lens.projects,
        "dim_date": calendar.dim_date(fact_bounds(lens)),
        "dim_exchange_rates": lens.exchange_rates,
        "fact_timesheets": None,
    }
    report = []
    for table, frame in content.items():
        lake.recreate(table)
        before = lake.read(table).count()
        if frame is not None:
            lake.append(frame, table)
        report.append((table, len(TABLES[table].fields), before, lake.read(table).count()))
    return lens.spark.createDataFrame(
        report, "table_name string, column_count long, rows_before long, rows_after long"
    )


@query
def load_audit(lens):
    """Rows written per load, counted while writing."""
    lake = new_lake(lens.spark)
    loads = [
        ("dim_date", lake.replace(calendar.dim_date(fact_bounds(lens)), "dim_date")),
        ("dim_employees", lake.replace(lens.employees, "dim_employees")),
        ("dim_projects", lake.replace(lens.projects, "dim_projects")),
        ("dim_exchange_rates", lake.append(lens.exchange_rates, "dim_exchange_rates")),
        ("fact_timesheets", lake.append(lens.timesheets, "fact_timesheets")),
    ]
    return lens.spark.createDataFrame(loads, "table_name string, rows_loaded long")


# --- silver and gold ----------------------------------------------------------

@query
def silver_employees(lens):
    return silver.silver_employees(lens.employees)


@query
def silver_projects(lens):
    return silver.silver_projects(lens.projects)


@query
def silver_timesheets(lens):
    return silver_facts(lens)


@query
def silver_exchange_rates(lens):
    return silver.silver_exchange_rates(lens.exchange_rates)


@query
def gold_employees(lens):
    return gold.gold_employees(
        silver.silver_employees(lens.employees),
        silver.silver_exchange_rates(lens.exchange_rates),
    )


@query
def gold_timesheets_enriched(lens):
    return enriched(lens)


@query
def gold_totals(lens):
    return gold.gold_totals(enriched(lens))


# --- profiles -----------------------------------------------------------------

@query
def preview(lens):
    return profile.preview(lens.timesheets, "timesheet_id", "load_timestamp")


@query
def profile_date_range(lens):
    return profile.date_range(lens.timesheets)


@query
def profile_department_nulls(lens):
    return profile.department_nulls(lens.employees)


@query
def profile_hours(lens):
    return profile.hours(lens.timesheets)


@query
def profile_messy_names(lens):
    return profile.messy_names(lens.employees)


@query
def profile_regions(lens):
    return profile.regions(lens.employees)


@query
def profile_currencies(lens):
    return profile.currencies(lens.employees)


@query
def profile_fx(lens):
    return profile.exchange_rates(lens.exchange_rates)


@query
def profile_designations(lens):
    return profile.designations(lens.employees)


@query
def profile_markets(lens):
    return profile.markets(lens.projects)


@query
def profile_markets_counted(lens):
    return profile.markets(lens.projects, base=None)


@query
def profile_bench_row(lens):
    return profile.bench_row(lens.projects)


@query
def profile_entry_types(lens):
    return profile.entry_types(lens.timesheets)


@query
def profile_uuid_uniqueness(lens):
    return profile.id_uniqueness(lens.timesheets)


@query
def profile_batches(lens):
    return profile.batches(lens.timesheets)


# --- calendar and exchange rates ----------------------------------------------

@query
def dim_date(lens):
    return calendar.dim_date(fact_bounds(lens))


def month_documents(lens):
    """A document per month; none in some months, a worthless one in others."""
    turn = (F.year("fx_month") * 12 + F.month("fx_month")) % 9
    units = F.when((turn == 5) & (F.col("currency_code") == "PKR"), 0.0).otherwise(
        F.round((1 / F.col("rate_to_usd")).cast("decimal(28,10)"), 6).cast("double")
    )
    quotes = lens.exchange_rates.filter("currency_code <> 'USD'").filter(turn != 4)
    entries = F.collect_list(F.struct("currency_code", units))
    return quotes.groupBy("fx_month").agg(F.map_from_entries(entries).alias("rates"))


@query
def fx_carry_forward(lens):
    bounds = fact_bounds(lens).withColumn("first_day", F.trunc("first_day", "MM"))
    return fx.carry_forward(fx.fetched_rates(month_documents(lens)), bounds)


@query
def fx_new_keys(lens):
    known = lens.exchange_rates.filter("fx_month < DATE '1999-01-01' OR currency_code = 'GBP'")
    return fx.new_rates(lens.exchange_rates, known)


@query
def fx_duplicate_keys(lens):
    again = lens.exchange_rates.filter(F.month("fx_month") == 1)
    return keys.duplicate_keys(lens.exchange_rates.unionByName(again), FX_KEY)


# --- projects, schedules, days ------------------------------------------------

@query
def client_projects(lens):
    return project_plans.client_projects(lens.projects)


@query
def projects_with_bench(lens):
    return project_plans.with_bench(lens.clients)


@query
def schedule_asof(lens):
    return active_project(lens.event_probes, lens.event_schedule)


@query
def build_schedule(lens):
    return schedule.build_schedule(
        lens.cycles, lens.assignments, dt.date(1998, 1, 1), dt.date(1996, 1, 1)
    )


@query
def employee_day_spine(lens):
    """The spine of the whole history, counted per employee and month."""
    days = schedule.employee_days(
        lens.employees, dt.date(1995, 1, 1), dt.date(2001, 12, 31),
        lens.absences, lens.weekend_work,
    )
    month = F.trunc("work_date", "MM").alias("fx_month")
    return days.groupBy("emp_id", month).agg(
        F.count(F.lit(1)).alias("day_count"),
        F.min("work_date").alias("first_day"),
        F.max("work_date").alias("last_day"),
    )


# --- facts --------------------------------------------------------------------

@query
def rate_card_lookup(lens):
    days = lens.timesheets.select(
        "timesheet_id", "load_timestamp", "emp_id", "project_id",
        F.add_months("work_date", 12 * 28).alias("work_date"),
    )
    staffed = days.join(lens.markets, "project_id", "left").join(
        lens.roster.select("emp_id", "designation"), "emp_id"
    )
    return facts.rate_card(staffed).drop("emp_id", "project_id")


@query
def salary_band_check(lens):
    return facts.salary_bands(lens.roster)


@query
def non_billable_chance(lens):
    days = lens.timesheets.select(
        "timesheet_id", "load_timestamp", "emp_id", "project_id", "work_date"
    )
    return facts.non_billable_chance(days.join(lens.roster.select("emp_id", "department"), "emp_id"))


@query
def fact_metrics(lens):
    return wall_clock(facts.fact_metrics(lens.entries, BATCH, LOADED_AT))


@query
def fact_quarantine(lens):
    accepted, rejected = checks.split_by_range(facts.fact_metrics(lens.entries, BATCH, LOADED_AT))
    both = accepted.unionByName(rejected, allowMissingColumns=True)
    return both.select("timesheet_id", "project_id", "hours_worked", "allocation_pct", "reason")


@query
def fact_row_id(lens):
    return lens.timesheets.select(
        "timesheet_id", "load_timestamp", keys.row_id(*NATURAL_KEY).alias("row_id")
    )


@query
def apply_corrections(lens):
    return facts.apply_corrections(silver_facts(lens), lens.adjustments)


@query
def correction_lineage(lens):
    return facts.correction_lineage(silver_facts(lens))


@query
def broken_references(lens):
    return facts.broken_references(silver_facts(lens)).select(
        "timesheet_id", "original_timesheet_id"
    )


# --- checks and the incremental load ------------------------------------------

@query
def natural_key_duplicates(lens):
    return keys.duplicate_keys(lens.timesheets, NATURAL_KEY)


@query
def natural_key_duplicate_rows(lens):
    return keys.duplicate_members(lens.timesheets, NATURAL_KEY).select(
        *NATURAL_KEY, "timesheet_id", "load_timestamp", "hours_worked"
    )


@query
def not_null_report(lens):
    tables = {
        "dim_employees": (lens.employees, EMPLOYEES),
        "dim_projects": (lens.projects, PROJECTS),
        "dim_exchange_rates": (lens.exchange_rates, EXCHANGE_RATES),
        "fact_timesheets": (lens.timesheets, TIMESHEETS),
    }
    report = None
    for table, (frame, schema) in tables.items():
        part = checks.null_report(frame, table, schema)
        report = part if report is None else report.unionByName(part)
    return report


@query
def expectation_report(lens):
    return checks.expectation_report(
        lens.timesheets, lens.employees, lens.projects, lens.exchange_rates,
        dt.date(1995, 1, 2), dt.date(2001, 12, 31), {"fx_rows": (560, 600)},
    )


@query
def incremental_start(lens):
    return load.high_water_mark(lens.timesheets)


@query
def incremental_load(lens):
    """Two loads that meet at a day in between, and a third that finds nothing to do."""
    timeline = schedule.build_schedule(
        lens.cycles, lens.assignments, dt.date(2001, 12, 31), dt.date(1995, 1, 1)
    )
    inputs = load.Inputs(
        lens.employees, timeline, lens.daily_entries, lens.absences,
        lens.weekend_work, lens.daily_adjustments,
    )
    lake = new_lake(lens.spark)
    for last in (dt.date(1998, 6, 30), dt.date(2001, 12, 31), dt.date(2001, 12, 31)):
        load.load_increment(lake, inputs, last, dt.date(1995, 1, 1))
    return wall_clock(lake.read("fact_timesheets").drop("load_timestamp", "batch_id"))


def deliver(entries, folder):
    """The entries as the files a stream reads."""
    with tidy(entries.sparkSession):
        entries.write.option("compression", COMPRESSION).parquet(folder)


@query
def streaming_load(lens):
    """The entries as files, loaded by a stream that ends when all are read."""
    lake = new_lake(lens.spark)
    folder = work_folder(lens.spark)
    entries = lens.joined_once(f"{folder}/raw").daily_entries
    deliver(entries, f"{folder}/entries")
    discard(lens.spark, f"{folder}/raw")
    stream = lens.spark.readStream.schema(entries.schema).parquet(f"{folder}/entries")
    load_entries(lake, stream, f"{folder}/checkpoint").awaitTermination()
    return wall_clock(lake.read("fact_timesheets").drop("load_timestamp", "batch_id"))


@query
def load_quarantine(lens):
    """What three loads of all lines set aside, of employees with a known department, and how many rows they loaded."""
    lens = lens.joined_once()
    timeline = schedule.build_schedule(
        lens.cycles, lens.assignments, dt.date(2001, 12, 31), dt.date(1995, 1, 1)
    )
    inputs = load.Inputs(
        lens.employees.filter("department IS NOT NULL"), timeline, lens.entries, lens.absences,
        lens.weekend_work, lens.daily_adjustments,
    )
    lake = new_lake(lens.spark)
    for last in (dt.date(1997, 6, 30), dt.date(1997, 6, 30), dt.date(2001, 12, 31)):
        load.load_increment(lake, inputs, last, dt.date(1995, 1, 1), conflicts="set aside")
    columns = ["timesheet_id", "emp_id", "work_date", "project_id", "hours_worked", "allocation_pct"]
    accepted = lake.read("fact_timesheets").filter("NOT is_correction").select(*columns, F.lit("accepted").alias("reason"))
    return accepted.unionByName(lake.read("quarantine_timesheets").select(*columns, "reason"))


@query
def streaming_conflicts(lens):
    """All lines as deliveries: the first in range of a key is the fact, later ones that say something else are
    set aside."""
    lake = new_lake(lens.spark)
    folder = work_folder(lens.spark)
    lines = lens.numbered_entries
    deliver(lines, f"{folder}/entries")
    stream = lens.spark.readStream.schema(lines.schema).parquet(f"{folder}/entries")
    load_entries(lake, stream.withColumnRenamed("line", "arrival"), f"{folder}/checkpoint").awaitTermination()
    columns = ["timesheet_id", "emp_id", "work_date", "project_id", "hours_worked", "allocation_pct", "is_billable",
               "hourly_rate_usd"]
    accepted = lake.read("fact_timesheets").filter("NOT is_correction").select(*columns, F.lit("accepted").alias("reason"))
    return accepted.unionByName(lake.read("quarantine_timesheets").select(*columns, "reason"))


@query
def gold_bucketed(lens):
    """Gold over a fact in buckets of its id, which needs no shuffle to find the latest versions."""
    lake = new_lake(lens.spark)
    lake.append_clustered(lens.timesheets, "fact_by_id", ["timesheet_id"], ["emp_id", "project_id"],
                          task_count(lens.spark))
    return gold.gold_from_bronze(
        lake.read("fact_by_id"), lens.employees, lens.projects, lens.exchange_rates)


@query
def gold_from_views(lens):
    """Gold by name, from a session that knows the catalog only."""
    lake = new_lake(lens.spark)
    lake.append(lens.timesheets, "fact_timesheets")
    for table, frame in (("dim_employees", lens.employees), ("dim_projects", lens.projects),
                         ("dim_exchange_rates", lens.exchange_rates)):
        lake.replace(frame, table)
    store_views(lake)
    return lens.spark.newSession().table(lake.name("gold_timesheets_enriched"))


@query
def daily_run(lens):
    """Two days of the daily run, the first of which fails at its facts and is resumed."""
    sources = Sources(
        lens.employees, lens.clients.drop("client_country").join(lens.markets, "project_id"), month_documents(lens),
        lens.cycles, lens.assignments, lens.daily_entries.drop("hourly_rate_usd"), lens.absences, lens.weekend_work,
        lens.daily_adjustments, dt.date(1995, 1, 1),
    )
    lake = new_lake(lens.spark)
    broken = lens.daily_entries.withColumn("base_hours", F.raise_error(F.lit("unreadable")).cast("double"))
    try:
        run_day(lake, dataclasses.replace(sources, entries=broken), dt.date(1998, 6, 30))
    except Exception as error:
        if "unreadable" not in str(error):
            raise
    for today in (dt.date(1998, 6, 30), dt.date(2001, 12, 31), dt.date(2001, 12, 31)):
        run_day(lake, sources, today)
    return lake.read("fact_timesheets").select(
        "timesheet_id", "emp_id", "work_date", "project_id", "entry_type", "hours_worked", "hourly_rate_usd",
        "revenue_usd")


@query
def profile_uuid_sketches(lens):
    """Distinct ids by year from daily sketches, held against the exact count."""
    daily = profile.daily_id_sketches(lens.timesheets)
    years = daily.withColumn("year", F.year("work_date").cast("long")).groupBy("year")
    estimated = years.agg(profile.distinct_ids(F.col("id_sketch")).alias("estimate"))
    exact = lens.timesheets.groupBy(F.year("work_date").cast("long").alias("year")).agg(
        F.count_distinct("timesheet_id").alias("distinct_ids"))
    near = F.abs(F.col("estimate") - F.col("distinct_ids")) <= F.col("distinct_ids") * 0.03
    return exact.join(estimated, "year").select("year", "distinct_ids", near.alias("estimate_is_near"))


@query
def fx_load_documents(lens):
    """Dated files, some of them broken, into the rate table; a second load appends nothing."""
    lake = new_lake(lens.spark)
    folder = work_folder(lens.spark)
    good = month_documents(lens).select("fx_month", F.to_json(F.struct("rates")).alias("value"))
    months = lens.exchange_rates.select("fx_month").distinct()
    broken = months.join(good, "fx_month", "left_anti").withColumn("value", F.lit('{"rates": {"PKR": '))
    good.unionByName(broken).repartition("fx_month").write.partitionBy("fx_month").text(folder)
    documents = fx_documents.read_dated_documents(lens.spark, folder)
    bounds = fact_bounds(lens).withColumn("first_day", F.trunc("first_day", "MM"))
    for _ in range(2):
        fx.load_exchange_rates(lake, documents, bounds)
    faults = fx_documents.document_faults(documents).groupBy("fx_month").agg(F.max("reason").alias("fault"))
    return lake.read("dim_exchange_rates").join(faults, "fx_month", "left")
