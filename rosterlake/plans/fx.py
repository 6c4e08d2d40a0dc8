"""The exchange-rate table: reciprocal rates, outage months, append of new keys."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rosterlake.constants import BASE_CURRENCY, FX_CURRENCIES
from rosterlake.functions.numbers import usd_per_unit
from rosterlake.operators.checks import require_unique_rates
from rosterlake.operators.keys import missing_keys
from rosterlake.plans.calendar import series
from rosterlake.schemas import EXCHANGE_RATES, FX_KEY
from rosterlake.sources.fx_documents import is_complete

STAGING = "staging_exchange_rates"
_COLUMNS = [f.name for f in EXCHANGE_RATES.fields]


def fetched_rates(documents):
    """Rates of the months with a complete document, the base currency at 1.0 added; one pass."""
    quoted = F.transform(F.map_entries("rates"), lambda e: F.struct(
        e["key"].alias("currency_code"), usd_per_unit(e["value"]).alias("rate_to_usd")))
    base = F.array(F.struct(F.lit(BASE_CURRENCY).alias("currency_code"), F.lit(1.0).alias("rate_to_usd")))
    return (
        documents.filter(is_complete(F.col("rates")) & F.col("fx_month").isNotNull())
        .select("fx_month", F.lit(BASE_CURRENCY).alias("base_currency"), F.inline(F.concat(quoted, base)))
        .select(*_COLUMNS)
    )


def carry_forward(fetched, bounds, currencies=FX_CURRENCIES, fill_gaps=False):
    """Fetched rates plus the last known ones for months not fetched at all.

    A month that was fetched without some currency keeps that gap, unless fill_gaps,
    and does not erase the memory of the currency. Rows of an outage month whose
    currency was never known come out with a null rate: see require_known_rates.

    The fetched rates are read once, as one list per month, no longer than the list of
    currencies; the windows hold one currency's months, so their size is set by the calendar.
    """
    months = series(bounds, F.col("first_day"), F.col("last_day"), months=True, name="fx_month")
    quote = F.struct("currency_code", F.col("rate_to_usd").alias("_quoted"))
    by_month = fetched.groupBy("fx_month").agg(F.collect_list(quote).alias("_quotes"))
    base = F.lit(BASE_CURRENCY)
    only_base = F.array(F.struct(base.alias("currency_code"), F.lit(1.0).alias("_quoted")))
    held = F.coalesce("_quotes", only_base)
    absent = F.array_except(F.array(*[F.lit(c) for c in currencies]), held["currency_code"])
    nothing = F.lit(None).cast("double").alias("_quoted")
    every = F.concat(held, F.transform(absent, lambda c: F.struct(c.alias("currency_code"), nothing)))
    spine = months.select("fx_month").join(by_month, "fx_month", "left").select(
        "fx_month", F.col("_quotes").isNull().alias("_outage"), F.inline(every))
    so_far = (
        Window.partitionBy("currency_code")
        .orderBy("fx_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    known = spine.withColumn("rate_to_usd", F.last("_quoted", ignorenulls=True).over(so_far))
    wanted = F.col("_quoted").isNotNull() | F.col("_outage")
    if fill_gaps:
        wanted = wanted | F.col("rate_to_usd").isNotNull()
    return known.filter(wanted).withColumn("base_currency", base).select(*_COLUMNS)


def require_known_rates(rates):
    """Raise for the first outage month without any earlier rate, naming the currencies."""
    unknown = rates.filter(F.col("rate_to_usd").isNull())
    first = (
        unknown.groupBy("fx_month")
        .agg(F.array_sort(F.collect_set("currency_code")).alias("currencies"))
        .orderBy("fx_month")
        .head(1)
    )
    if first:
        raise RuntimeError(
            f"No prior exchange rate for {', '.join(first[0]['currencies'])} "
            f"on {first[0]['fx_month']}"
        )


def new_rates(rates, existing):
    """One row per key the table does not hold yet."""
    return missing_keys(rates, existing, FX_KEY)


def load_exchange_rates(lake, documents, bounds, currencies=FX_CURRENCIES):
    """Build, check, and append the missing months; returns the number of new rows.

    The documents are read once, into a staging table that the checks and the append read.
    """
    lake.replace(fetched_rates(documents), STAGING, EXCHANGE_RATES)
    fetched = lake.read(STAGING)
    require_unique_rates(fetched)
    rates = carry_forward(fetched, bounds, currencies)
    require_known_rates(rates)
    count = lake.append(
        new_rates(rates, lake.read_or_empty("dim_exchange_rates")), "dim_exchange_rates"
    )
    lake.drop(STAGING)
    return count
