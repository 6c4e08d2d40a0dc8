"""Rounding and exact sums over doubles."""

from pyspark.sql import functions as F

_WIDE = "decimal(28,10)"


def round_half_up(column, digits):
    """Round half away from zero on the decimal value of a double.

    Rounding the binary value instead depends on the engine for near-ties. What does
    not fit the decimal, from 1e18 on, has no decimals to round and stays as it is,
    as do NaN and infinity.
    """
    return F.coalesce(F.round(column.try_cast(_WIDE), digits).cast("double"), column)


def half_hours(column):
    """Quantise to half hours, ties to even."""
    return F.bround(column * 2, 0) / F.lit(2.0)


def usd_per_unit(units_per_usd):
    """Reciprocal rate to six digits; null for a null or zero rate."""
    return round_half_up(F.try_divide(F.lit(1.0), units_per_usd), 6)


def _exact_sum(column):
    """A decimal sum, the same whatever the order of the rows, and whether some value does not fit it."""
    exact = column.try_cast(_WIDE)
    return F.sum(exact), F.max(column.isNotNull() & exact.isNull())


def money_sum(column):
    """Exact sum, rounded to cents once. NaN, infinity or a value from 1e18 on shows in a double sum."""
    exact, unfit = _exact_sum(column)
    return F.when(unfit, F.sum(column.cast("double"))).otherwise(F.round(exact, 2).cast("double"))


def exact_avg(column):
    """Average of an exact sum, so that a retry returns the same digits; as money_sum for what does not fit."""
    exact, unfit = _exact_sum(column)
    total = F.when(unfit, F.sum(column.cast("double"))).otherwise(exact.cast("double"))
    return F.try_divide(total, F.count(column).cast("double"))


def percent(part, whole):
    return F.try_divide(part * F.lit(100.0), whole.cast("double"))
