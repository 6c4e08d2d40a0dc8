"""One explicit StructType per table."""

from pyspark.sql import types as T

_L, _D, _S, _B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
_DATE, _TS = T.DateType(), T.TimestampType()


def _struct(required, optional=()):
    fields = [T.StructField(n, t, False) for n, t in required]
    return T.StructType(fields + [T.StructField(n, t, True) for n, t in optional])


EMPLOYEES = _struct(
    [("emp_id", _L), ("name", _S)],
    [("department", _S), ("designation", _S), ("local_salary", _D),
     ("currency", _S), ("region", _S), ("join_date", _DATE)],
)

PROJECTS = _struct(
    [("project_id", _L), ("project_name", _S)],
    [("client_name", _S), ("client_country", _S)],
)

CALENDAR = _struct(
    [("date_key", _DATE)],
    [("year", _L), ("quarter", _L), ("month", _L), ("month_name", _S),
     ("day_of_week", _S), ("is_weekend", _B)],
)

EXCHANGE_RATES = _struct(
    [("fx_month", _DATE), ("base_currency", _S), ("currency_code", _S)],
    [("rate_to_usd", _D)],
)

TIMESHEETS = T.StructType([
    T.StructField("timesheet_id", _S, False),
    T.StructField("emp_id", _L, False),
    T.StructField("project_id", _L, False),
    T.StructField("work_date", _DATE, False),
    T.StructField("fx_month", _DATE, False),
    T.StructField("created_at", _TS, False),
    T.StructField("hours_worked", _D, False),
    T.StructField("is_billable", _B, False),
    T.StructField("hourly_rate_usd", _D, False),
    T.StructField("revenue_usd", _D, False),
    T.StructField("allocation_pct", _D, False),
    T.StructField("is_anomaly", _B, False),
    T.StructField("is_weekend_work", _B, False),
    T.StructField("is_correction", _B, False),
    T.StructField("entry_type", _S, False),
    T.StructField("original_timesheet_id", _S, True),
    T.StructField("load_timestamp", _TS, False),
    T.StructField("batch_id", _S, False),
])

# FX snapshot document: local units per 1 USD, one document per month
FX_DOCUMENT = T.StructType([
    T.StructField("fx_month", _DATE, True),
    T.StructField("rates", T.MapType(_S, _D), True),
])

SCHEDULE = _struct(
    [("emp_id", _L), ("project_id", _L), ("start_date", _DATE), ("end_date", _DATE)]
)

# facts set aside by a load, with the reason
QUARANTINE = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in TIMESHEETS.fields]
    + [T.StructField("reason", _S, False)]
)

TABLES = {
    "dim_employees_source": EMPLOYEES,
    "dim_projects_source": PROJECTS,
    "dim_employees": EMPLOYEES,
    "dim_projects": PROJECTS,
    "dim_date": CALENDAR,
    "dim_exchange_rates": EXCHANGE_RATES,
    "fact_timesheets": TIMESHEETS,
    "quarantine_timesheets": QUARANTINE,
}

PARTITIONING = {"fact_timesheets": ["work_date"]}

NATURAL_KEY = ["emp_id", "work_date", "entry_type"]
FX_KEY = ["fx_month", "currency_code"]


def required_columns(schema):
    return [f.name for f in schema.fields if not f.nullable]
