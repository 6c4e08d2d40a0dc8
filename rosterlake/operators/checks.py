"""Validation: raise, report, or set aside."""

from pyspark.sql import functions as F

from rosterlake.constants import EXPECTATIONS, MAX_DAY_HOURS
from rosterlake.functions.numbers import percent
from rosterlake.operators.keys import duplicate_keys, stored_on_days
from rosterlake.schemas import FX_KEY, NATURAL_KEY, required_columns


def require_unique(frame, key, what):
    """Raise when a key occurs twice. Nothing but one key travels to the driver."""
    found = duplicate_keys(frame, key).head(1)
    if found:
        shown = ", ".join(f"{k}={found[0][k]}" for k in key)
        raise ValueError(f"Duplicate {what}: {shown} ({found[0]['row_count']} rows)")


def require_unique_facts(facts):
    require_unique(facts, NATURAL_KEY, "natural key")


def stored_duplicates(facts, table, key=NATURAL_KEY):
    """The rows of a batch whose key the table holds already; of the table only their days are read."""
    held = stored_on_days(facts, table, key)
    return facts.join(held, key, "left_semi")


def require_unstored_facts(facts, table):
    """Raise when the table holds a key of the batch."""
    found = stored_duplicates(facts, table).select(*NATURAL_KEY).head(1)
    if found:
        shown = ", ".join(f"{k}={found[0][k]}" for k in NATURAL_KEY)
        raise ValueError(f"Natural key is in the table already: {shown}")


def require_unique_rates(rates):
    require_unique(rates, FX_KEY, "exchange-rate key")


def null_report(frame, table, schema):
    """Null count per column, from one pass over the table."""
    counts = frame.agg(*[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in schema.fields])
    required = set(required_columns(schema))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.name in required).alias("is_required"),
            F.col(f.name).alias("null_count"),
        )
        for f in schema.fields
    ]
    return counts.select(F.inline(F.array(*rows))).select(
        F.lit(table).alias("table_name"),
        "column_name",
        "is_required",
        "null_count",
        (~F.col("is_required") | (F.col("null_count") == 0)).alias("passed"),
    )


def require_not_null(frame, table, schema):
    """Parquet accepts a null in a NOT NULL column, so the check is explicit."""
    failed = null_report(frame, table, schema).filter(~F.col("passed")).collect()
    if failed:
        raise ValueError(f"Null in required columns of {table}: "
                         + ", ".join(r["column_name"] for r in failed))


def with_reason(entries, max_hours=MAX_DAY_HOURS):
    """Why a row is out of range; null for a row to accept. Missing counts as out.

    A reason that the row has already stands.
    """
    hours_ok = F.abs("hours_worked") <= max_hours
    share_ok = (F.col("allocation_pct") > 0) & (F.col("allocation_pct") <= 1)
    reason = F.when(~F.coalesce(hours_ok, F.lit(False)), "hours out of range").when(
        ~F.coalesce(share_ok, F.lit(False)), "allocation out of range"
    )
    if "reason" in entries.columns:
        reason = F.coalesce(F.col("reason"), reason)
    return entries.withColumn("reason", reason)


def split_by_range(entries, max_hours=MAX_DAY_HOURS):
    """(accepted, quarantined); together they are the input."""
    judged = with_reason(entries, max_hours)
    accepted = judged.filter(F.col("reason").isNull()).drop("reason")
    return accepted, judged.filter(F.col("reason").isNotNull())


def expectation_report(timesheets, employees, projects, rates, expected_start, expected_end,
                       bounds=None):
    """One row per stated expectation: name, observed, low, high, passed."""
    bounds = {**EXPECTATIONS, **(bounds or {})}
    rows = F.count(F.lit(1))

    def share(condition):
        return percent(F.count_if(condition), rows)

    padded = F.col("name").like(" %") | F.col("name").like("% ")
    observed = [
        (timesheets, {
            "history_start_offset_days": F.datediff(F.min("work_date"), F.lit(expected_start)),
            "history_end_lag_days": F.datediff(F.lit(expected_end), F.max("work_date")),
            "negative_hours_pct": share(F.col("hours_worked") < 0),
            "correction_pct": share(F.col("entry_type") == "correction"),
            "duplicate_ids": rows - F.count_distinct("timesheet_id"),
        }),
        (employees, {
            "null_department_pct": share(F.col("department").isNull()),
            "padded_name_pct": share(padded),
            "pkr_salary_pct": share(F.col("currency") == "PKR"),
        }),
        (projects, {
            "client_projects": F.count_if(F.col("project_id") != -1),
            "bench_rows": F.count_if(F.col("project_id") == -1),
        }),
        (rates, {"fx_rows": rows}),
    ]
    report = None
    for frame, measures in observed:
        line = frame.agg(*[m.cast("double").alias(n) for n, m in measures.items()])
        structs = [
            F.struct(
                F.lit(n).alias("expectation"),
                F.col(n).alias("observed"),
                F.lit(float(bounds[n][0])).alias("low"),
                F.lit(float(bounds[n][1])).alias("high"),
            )
            for n in measures
        ]
        part = line.select(F.inline(F.array(*structs)))
        report = part if report is None else report.unionByName(part)
    passed = F.coalesce(F.col("observed").between(F.col("low"), F.col("high")), F.lit(False))
    return report.withColumn("passed", passed)
