"""The incremental load of the timesheet fact."""

import dataclasses
import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.constants import HISTORY_START
from rosterlake.operators.asof import active_project
from rosterlake.operators.checks import require_not_null, require_unique_facts, with_reason
from rosterlake.operators.keys import duplicate_keys, fingerprint, row_id, stored_on_days
from rosterlake.plans.facts import BASE, COLUMNS, base_corrections, complete, fact_metrics, rate_card
from rosterlake.plans.projects import client_projects
from rosterlake.plans.schedule import judge_days
from rosterlake.schemas import NATURAL_KEY, TIMESHEETS
from rosterlake.session import COMPRESSION, tidy

FACT = "fact_timesheets"
QUARANTINE = "quarantine_timesheets"
STAGING = "staging_load_"
# not whole before they are renamed, or made from a staging table: what a lost run leaves under this name is dropped
UNFINISHED = "unfinished_load_"
# a load of more rows is computed in so many parts by key, and the shuffle files of one part go before the next
PART_ROWS = 2_000_000
PARTS = 8
# an original's id is a function of these
KEY = ["emp_id", "work_date"]
CONTENT = ["project_id", "hours_worked", "allocation_pct", "is_billable", "hourly_rate_usd"]


@dataclass
class Inputs:
    """What one load reads.

    entries: emp_id, work_date, base_hours, allocation_pct, is_billable, hourly_rate_usd.
    adjustments: emp_id, work_date, adjusted_hours.
    projects: project_id, client_country; if given, the rate card sets the hourly rates, by the
    project's market, the employee's designation and the year (see facts.rate_card).
    """

    employees: DataFrame
    schedule: DataFrame
    entries: DataFrame
    absences: DataFrame
    weekend_work: DataFrame
    adjustments: DataFrame
    projects: DataFrame | None = None


@dataclass
class Outcome:
    """Rows written and rows set aside by one load."""

    first: dt.date
    last: dt.date
    loaded: int
    quarantined: int
    batch_id: str


def new_batch(now=None):
    """(batch id, load timestamp): drawn once per run, on the driver."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return f"RUN-{now:%Y%m%d-%H%M%S}-{uuid.uuid4().hex[:8]}", now


def high_water_mark(facts, history_start=HISTORY_START):
    """One row: the last loaded day and the next day to load.

    facts may be the fact or, cheaper, the days its partitions are listed under.
    """
    last = F.max("work_date")
    return facts.agg(
        last.alias("last_loaded"),
        F.coalesce(F.date_add(last, 1), F.lit(history_start).cast("date")).alias("next_start"),
    )


def judged_facts(inputs, first, last, batch_id, load_timestamp):
    """Every entry for the days from first to last as a fact row, with its reason to be
    set aside, null for a row to load."""
    entries = judge_days(
        inputs.entries.drop("project_id", "reason"), inputs.employees, first, last,
        inputs.absences, inputs.weekend_work,
    )
    staffed = active_project(entries, inputs.schedule)
    if inputs.projects is not None:
        staffed = card_rates(staffed, inputs.projects, inputs.employees)
    return with_reason(fact_metrics(staffed, batch_id, load_timestamp, keep=["reason"]))


def inputs_part(inputs, number, parts):
    """The inputs of one of so many parts, by employee, as everything but the projects is looked up by employee."""
    return dataclasses.replace(inputs, **{
        name: part(getattr(inputs, name), number, parts, ["emp_id"])
        for name in ("employees", "schedule", "entries", "absences", "weekend_work")})


def card_rates(staffed, projects, employees):
    """The entries with the hourly rate of the card; unknown markets and designations take its defaults."""
    markets = client_projects(projects)
    known = employees.select("emp_id", "designation")
    entries = staffed.drop("hourly_rate_usd", "client_country", "designation")
    return rate_card(entries.join(markets, "project_id", "left").join(known, "emp_id", "left"))


def settle(judged):
    """Judged rows with keys that occur more than once decided: a reason for all but one row per key.

    Equal rows of a key are repeats of the first. Unlike rows of a key contradict each other and none is
    loaded, whatever their order. Copies are counted map-side, so a key that fills a third of the
    rows is a few rows before it meets anything. The rows are originals and go by their base columns.
    """
    return complete(settle_base(judged), ["reason"])


def settle_base(judged):
    """Like settle, of and with the columns of BASE and the reason only."""
    counted = judged.groupBy(*BASE, "reason").agg(F.count(F.lit(1)).alias("_copies"))
    unlike = duplicate_keys(counted.filter(F.col("reason").isNull()), KEY).select(
        *[F.col(k).alias(f"_{k}") for k in KEY], F.lit("conflict").alias("_unlike"))
    decided = counted.join(unlike, same_key(), "left").withColumn("reason", F.coalesce("reason", "_unlike"))
    first = F.col("reason").isNull()
    reasons = F.when(first, F.concat(F.array(F.lit(None).cast("string")), F.array_repeat(
        F.lit("repeat"), (F.col("_copies") - 1).cast("int")))).otherwise(
            F.array_repeat("reason", F.col("_copies").cast("int")))
    return decided.select(*BASE, F.explode(reasons).alias("reason"))


def same_key():
    """Whether rows are of the same employee and day, as their ids are; the other side's columns begin with _."""
    both = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    return both[0] & both[1]


def keyed_originals(table, *columns):
    """The key, with _ before it, and the columns of a table's originals whose ids follow from their keys.

    Rows of one load are compared with them by key, which is a fraction of the id.
    """
    derived = (F.col("entry_type") == "original") & (F.col("timesheet_id") == row_id(*NATURAL_KEY))
    return table.filter(derived).select(*[F.col(k).alias(f"_{k}") for k in KEY], *columns)


def part(frame, number, parts, key):
    """The rows of one of so many parts; a key is whole in one."""
    return frame if parts == 1 else frame.filter(F.pmod(F.xxhash64(*key), F.lit(parts)) == number)


def parts_of(rows):
    """How many parts the rows are computed in."""
    with tidy(rows.sparkSession):
        return max(1, min(PARTS, -(-rows.count() // PART_ROWS)))


def unseen(rows, table):
    """Rows whose id the table does not hold; of the table only their days are read."""
    known = stored_on_days(rows, table, ["timesheet_id"]).distinct()
    return rows.join(known, ["work_date", "timesheet_id"], "left_anti").select(*rows.columns)


def newly_set_aside(rows, quarantine):
    """Originals that are not set aside yet with the same content for the same reason.

    Of the quarantine only the days that occur among rows are compared; where it has none of them, which is
    the rule, no row is shuffled.
    """
    said = fingerprint(*CONTENT, "reason")
    days = rows.select(F.col("work_date").alias("_day")).distinct()
    met = quarantine.join(F.broadcast(days), F.col("work_date").eqNullSafe(F.col("_day")), "left_semi")
    known = keyed_originals(met, said.alias("_known"))
    if known.isEmpty():
        return rows
    return rows.withColumn("_said", said).join(
        known.distinct(), same_key() & (F.col("_said") == F.col("_known")), "left_anti").select(*rows.columns)


def stage(lake, judged, staging):
    """Compute the originals once, into a table in the shared folder.

    The table appears in the catalog only when its files are complete. It holds the base columns, from
    which the others follow, and those a fact has not.
    """
    stage_parts(lake, lambda number: judged, 1, staging)


def stage_parts(lake, judged, parts, staging):
    """Like stage, one part after the other; judged gives the rows of a part by its number."""
    building = staging if parts == 1 else UNFINISHED + staging
    for number in range(parts):
        rows = judged(number)
        more = [c for c in rows.columns if c not in COLUMNS]
        with tidy(rows.sparkSession):
            rows.select(*BASE, *more).write.option("compression", COMPRESSION).mode(
                "append" if number else "errorifexists").saveAsTable(lake.name(building))
    if building != staging:
        lake.spark.sql(f"ALTER TABLE {lake.name(building)} RENAME TO {lake.name(staging)}")


def settled(lake, staging):
    """The staged rows settled, as a table whose name is returned: computed once, in parts by key."""
    table = f"{UNFINISHED}settled_{staging}"
    lake.drop(table)
    staged = lake.read(staging)
    parts = parts_of(staged)
    stage_parts(lake, lambda number: settle_base(part(staged, number, parts, KEY)), parts, table)
    return table


def publish(lake, staging, adjustments=None, skip_known=False, conflicts="raise"):
    """Check staged originals and append them with their corrections: (loaded, set aside).

    Corrections and checks read the staging table, and the fact gets one write, after
    one shuffle by day: nothing is computed again, and a failed check leaves the fact
    as it was. skip_known: leave out rows whose id is in the table already. conflicts: "raise"
    refuses a batch with a key that occurs twice; "set aside" loads the rest (see settle), and
    what is loaded and what is set aside are together the staged rows. The columns that follow from others
    are added as the rows are written.
    """
    tables = [settled(lake, staging), staging] if conflicts == "set aside" else [staging]
    with tidy(lake.spark):
        staged = lake.read(tables[0]).select(*BASE, "reason")
        facts = staged.filter(F.col("reason").isNull()).drop("reason").withColumn("entry_type", F.lit("original"))
        rejected = staged.filter(F.col("reason").isNotNull())
        if adjustments is not None:
            facts = facts.unionByName(base_corrections(facts, adjustments))
        try:
            require_not_null(complete(facts), FACT, TIMESHEETS)
            require_unique_facts(facts)
        except ValueError:
            for table in tables:
                lake.drop(table)
            raise
        if skip_known:
            facts = unseen(complete(facts), lake.read(FACT))
        loaded = lake.append(facts, FACT)
        # days without loaded rows are looked at again, and what was set aside stays so once
        rejected = complete(newly_set_aside(rejected, lake.read_or_empty(QUARANTINE)), ["reason"])
        set_aside = 0 if rejected.isEmpty() else lake.append(rejected, QUARANTINE)
    # not in a finally block: what a failed write leaves staged, the next run finishes
    for table in tables:
        lake.drop(table)
    return loaded, set_aside


def finish_lost_loads(lake, adjustments, conflicts="raise"):
    """Publish what a failed run left staged, but for the rows it had written.

    Without this, days written in part would lie below the high-water mark.
    """
    return sum(
        publish(lake, staging, adjustments, skip_known=True, conflicts=conflicts)[0]
        for staging in lake.tables(STAGING)
    )


def load_increment(lake, inputs, last, history_start=HISTORY_START, now=None, conflicts="raise"):
    """Append the days after the loaded ones, up to `last`; a second run adds nothing.

    Every entry of those days is either loaded or set aside with its reason.

    One load runs at a time: a staging table found at the start counts as left behind.
    """
    lake.create(FACT)
    lake.add_missing_columns(FACT)
    for left in lake.tables(UNFINISHED):
        lake.drop(left)
    recovered = finish_lost_loads(lake, inputs.adjustments, conflicts)
    with tidy(lake.spark):
        first = high_water_mark(lake.partition_days(FACT), history_start).head()["next_start"]
    batch_id, load_timestamp = new_batch(now)
    if first > last:
        return Outcome(first, last, recovered, 0, batch_id)
    staging = STAGING + batch_id.replace("-", "_").lower()
    day = F.col("work_date")
    parts = parts_of(inputs.entries.filter((day >= F.lit(first)) & (day <= F.lit(last))))

    def judged(number):
        return judged_facts(inputs_part(inputs, number, parts), first, last, batch_id, load_timestamp)

    stage_parts(lake, judged, parts, staging)
    loaded, set_aside = publish(lake, staging, inputs.adjustments, conflicts=conflicts)
    return Outcome(first, last, recovered + loaded, set_aside, batch_id)
