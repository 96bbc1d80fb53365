"""Exact decimal rounding of ratios and means.

``round(x, 2)`` on a DOUBLE depends on binary representation, and a DECIMAL
average is itself pre-rounded by the engine, so rounding it again can round
twice.  These helpers work on integers only: the result is the ratio rounded
half away from zero (the rule of SQL ``round`` on NUMERIC), then returned as
``DECIMAL(precision, scale)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_PRECISION = 20


def _idiv(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def round_ratio(num: Column, den: Column, scale: int = 2, precision: int = RESULT_PRECISION) -> Column:
    """round(num / den, scale), half away from zero; NULL when den is 0 or NULL.  ``num``/``den`` are integral."""
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    factor = F.lit(10**scale).cast("decimal(38,0)")
    an, ad = F.abs(n), F.abs(d)
    q = _idiv(an * factor * 2 + ad, ad * 2)
    signed = F.when(F.signum(n) * F.signum(d) < 0, -q).otherwise(q)
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(T.DecimalType(scale + 1, scale))
    out = (signed.cast(f"decimal({precision},0)") * unit).cast(T.DecimalType(precision, scale))
    return F.when(d != 0, out)


def round_percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """round(100 * part / whole, scale) exactly."""
    return round_ratio(part.cast("decimal(38,0)") * 100, whole, scale)


def mean_of_cents(sum_cents: Column, count: Column, scale: int = 2) -> Column:
    """Mean of DECIMAL(.,2) values given their sum in hundredths, rounded to ``scale`` decimals."""
    # mean = sum_cents / (100 * count); rounded to `scale` digits
    return round_ratio(sum_cents, count * 100, scale)


def to_cents(x: Column) -> Column:
    """A DECIMAL(.,2) value as an integer number of hundredths."""
    return (x * 100).cast("decimal(38,0)")


#: DOUBLE values of this magnitude or more (also infinite ones) have no exact 6-digit units.
EXACT_BELOW = 1e15


def to_units(x: Column, digits: int) -> Column:
    """``x`` as an integer count of 10^-digits units (a DOUBLE is rounded half-up at that digit)."""
    return (x * (10**digits)).cast("decimal(38,0)")


def to_units_or_null(x: Column, digits: int) -> Column:
    """``to_units`` of a DOUBLE below ``EXACT_BELOW`` in magnitude, else NULL (never an error)."""
    return F.when(F.abs(x) < F.lit(EXACT_BELOW), to_units(x, digits))


def mean_of_units(sum_units: Column, count: Column, digits: int, scale: int = 2) -> Column:
    """Mean of values given their sum in 10^-digits units, rounded half away from zero to ``scale`` decimals."""
    return round_ratio(sum_units, count * (10**digits), scale)
