"""Timesheet facts: rates, bands, chances, metrics, corrections."""

from pyspark.sql import functions as F

from rosterlake import constants as C
from rosterlake.functions.dates import is_weekend, month_start
from rosterlake.functions.lookup import field, lookup
from rosterlake.functions.numbers import half_hours, round_half_up
from rosterlake.operators.keys import row_id
from rosterlake.schemas import NATURAL_KEY, TIMESHEETS

COLUMNS = [f.name for f in TIMESHEETS.fields]
# what a load keeps and shuffles of a fact; the other columns follow from these and the entry type (see complete)
BASE = ["emp_id", "project_id", "work_date", "hours_worked", "is_billable", "hourly_rate_usd", "allocation_pct",
        "load_timestamp", "batch_id"]


def rate_card(entries, market_rates=C.MARKET_RATES, year_factors=C.YEAR_FACTORS,
              designation_factors=C.RATE_FACTORS):
    """Add hourly_rate_usd: base rate x year factor x designation factor.

    entries: client_country, work_date, designation. The base rate is the midpoint
    of the market's band, which is added as rate_low and rate_high, unless the
    entries bring their own column base_rate_usd.
    """
    market = F.col("client_country")
    low = lookup(market, field(market_rates, 0), float(C.DEFAULT_MARKET_RATE[0]))
    high = lookup(market, field(market_rates, 1), float(C.DEFAULT_MARKET_RATE[1]))
    banded = entries.withColumns({"rate_low": low, "rate_high": high})
    if "base_rate_usd" in entries.columns:
        base = F.col("base_rate_usd")
    else:
        base = (F.col("rate_low") + F.col("rate_high")) / F.lit(2.0)
    year = lookup(F.year("work_date"), year_factors, C.DEFAULT_YEAR_FACTOR)
    designation = lookup(F.col("designation"), designation_factors, C.DEFAULT_RATE_FACTOR)
    return banded.withColumn("hourly_rate_usd", round_half_up(base * year * designation, 2))


def salary_bands(employees, bands=C.SALARY_BANDS, factors=C.SALARY_FACTORS):
    """Add band_min, band_max, band_currency and in_band.

    Regions match whatever their case, as some source rows are upper-cased. A
    region without a band gives nulls.
    """
    known = {region.lower(): band for region, band in bands.items()}
    region = F.lower("region")
    designation = F.col("designation")
    low = lookup(designation, field(factors, 0), C.DEFAULT_SALARY_FACTOR[0])
    high = lookup(designation, field(factors, 1), C.DEFAULT_SALARY_FACTOR[1])
    return employees.withColumns({
        "band_min": round_half_up(lookup(region, field(known, 0)) * low, 2),
        "band_max": round_half_up(lookup(region, field(known, 1)) * high, 2),
        "band_currency": lookup(region, field(known, 2)),
    }).withColumn("in_band", F.col("local_salary").between(F.col("band_min"), F.col("band_max")))


def non_billable_chance(entries, departments=C.DEPARTMENT_BENCH, season=C.SEASON):
    """Add the chance that a day is not billable; certain without a client project.

    entries: department, work_date, project_id.
    """
    bench = lookup(
        F.coalesce("department", F.lit("Unassigned")), departments, C.DEFAULT_DEPARTMENT_BENCH
    )
    share = lookup(F.month("work_date"), season, C.DEFAULT_SEASON)
    chance = bench * (F.lit(1.0) - share + F.lit(C.NON_BILLABLE_MARGIN))
    low, high = C.NON_BILLABLE_RANGE
    clamped = F.greatest(F.lit(low), F.least(F.lit(high), chance))
    on_bench = F.coalesce(F.col("project_id") == C.BENCH_PROJECT_ID, F.lit(True))
    return entries.withColumn("non_billable_chance", F.when(on_bench, 1.0).otherwise(clamped))


def fact_metrics(entries, batch_id, load_timestamp, keep=()):
    """Fact rows from raw entries; keep names columns to carry along.

    entries: emp_id, work_date, project_id (null or -1 on the bench), base_hours,
    allocation_pct, is_billable, hourly_rate_usd. On the bench the hours stand as
    they are, the allocation is 1.0 and nothing is billable.
    """
    project = F.coalesce("project_id", F.lit(C.BENCH_PROJECT_ID).cast("long"))
    on_bench = F.col("project_id") == C.BENCH_PROJECT_ID
    billable = ~on_bench & F.col("is_billable")
    staffed = entries.withColumn("project_id", project).withColumns({
        "is_billable": billable,
        "allocation_pct": F.when(on_bench, 1.0).otherwise(F.col("allocation_pct")),
        "hours_worked": F.when(on_bench, F.col("base_hours")).otherwise(
            half_hours(F.col("base_hours") * F.col("allocation_pct"))
        ),
        "hourly_rate_usd": F.when(billable, F.col("hourly_rate_usd")).otherwise(0.0),
        "load_timestamp": F.lit(str(load_timestamp)).cast("timestamp"),
        "batch_id": F.lit(batch_id),
    })
    return complete(staffed.select(*BASE, *keep), keep)


def complete(rows, keep=()):
    """Fact rows from their base columns; keep names columns to carry along.

    rows: the columns of BASE, and entry_type unless all are originals. An id is 64 characters that
    nothing compresses to less than 32, so large loads add these columns after their shuffles.
    """
    day, hours = F.col("work_date"), F.col("hours_worked")
    if "entry_type" not in rows.columns:
        rows = rows.withColumn("entry_type", F.lit("original"))
    correction = F.col("entry_type") == "correction"
    return rows.withColumns({
        "timesheet_id": row_id(*NATURAL_KEY),
        "fx_month": month_start(day),
        "created_at": day.cast("timestamp"),
        "revenue_usd": _revenue(hours),
        "is_anomaly": F.when(correction, True).otherwise(hours < 0),
        "is_weekend_work": is_weekend(day),
        "is_correction": correction,
        "original_timesheet_id": F.when(
            correction, F.sha2(F.concat_ws("|", F.col("emp_id").cast("string"), day.cast("string"), F.lit("original")), 256)),
    }).select(*COLUMNS, *keep)


def _revenue(hours):
    return F.when(
        F.col("is_billable"), round_half_up(hours * F.col("hourly_rate_usd"), 2)
    ).otherwise(0.0)


def correction_rows(facts, adjustments):
    """A negative entry for each adjustment of an original with hours.

    adjustments: timesheet_id, adjusted_hours. The hours are held between 0.5 and
    the smaller of 4 and the original's hours, in half hours.
    """
    worked = F.col("hours_worked")
    wanted = adjustments.filter(F.col("adjusted_hours").isNotNull()).select(
        "timesheet_id", "adjusted_hours"
    )
    originals = facts.filter((F.col("entry_type") == "original") & (worked > 0))
    return (
        wanted.join(originals, "timesheet_id")
        .withColumn("hours_worked", correction_hours())
        .withColumns({
            "original_timesheet_id": F.col("timesheet_id"),
            "entry_type": F.lit("correction"),
            "is_correction": F.lit(True),
            "is_anomaly": F.lit(True),
            "revenue_usd": _revenue(F.col("hours_worked")),
        })
        .withColumn("timesheet_id", row_id(*NATURAL_KEY))
        .select(*facts.columns)
    )


def correction_hours():
    """The hours of a correction from those of its original and the adjusted ones (see correction_rows)."""
    low, high = C.CORRECTION_RANGE
    allowed = F.greatest(F.lit(low), F.least(F.lit(high), F.abs("hours_worked")))
    return -half_hours(F.greatest(F.lit(low), F.least(F.col("adjusted_hours"), allowed)))


def base_corrections(originals, adjustments):
    """Like correction_rows, of rows that have the columns of BASE and entry_type only, by employee and day.

    adjustments: emp_id, work_date, adjusted_hours. Ids are a function of the natural key, so an
    adjustment finds the same original by either.
    """
    wanted = adjustments.filter(F.col("adjusted_hours").isNotNull()).select(
        F.col("emp_id").alias("_emp"), F.col("work_date").alias("_day"), "adjusted_hours")
    same = F.col("emp_id").eqNullSafe(F.col("_emp")) & F.col("work_date").eqNullSafe(F.col("_day"))
    return (
        originals.filter(F.col("hours_worked") > 0).join(wanted, same)
        .withColumns({"hours_worked": correction_hours(), "entry_type": F.lit("correction")})
        .select(*originals.columns)
    )


def apply_corrections(facts, adjustments):
    """The facts together with their correction rows."""
    return facts.unionByName(correction_rows(facts, adjustments))


def correction_lineage(timesheets):
    """Each correction beside its original; original_found tells broken references.

    timesheets: one row per id, as silver has them.
    """
    corrections = timesheets.filter("is_correction").select(
        "timesheet_id", "original_timesheet_id", "work_date",
        F.col("hours_worked").alias("correction_hours"),
        F.col("revenue_usd").alias("correction_revenue_usd"),
    )
    originals = timesheets.filter(~F.col("is_correction")).select(
        F.col("timesheet_id").alias("original_timesheet_id"),
        F.col("hours_worked").alias("original_hours"),
        F.lit(True).alias("_found"),
    )
    return corrections.join(originals, "original_timesheet_id", "left").select(
        "timesheet_id", "original_timesheet_id", "work_date", "correction_hours",
        "correction_revenue_usd", "original_hours",
        (F.col("original_hours") + F.col("correction_hours")).alias("net_hours"),
        F.coalesce("_found", F.lit(False)).alias("original_found"),
    )


def broken_references(timesheets):
    """Corrections whose original is not in the table."""
    originals = timesheets.filter(~F.col("is_correction")).select(
        F.col("timesheet_id").alias("original_timesheet_id")
    )
    return timesheets.filter("is_correction").join(
        originals.distinct(), "original_timesheet_id", "left_anti"
    ).select(*timesheets.columns)
