"""Calendar parts, Portuguese weekday names and the national-holiday flag.

The holiday flag is a pure expression (no join): fixed-date holidays match on
(month, day) for any year; movable holidays either come from the listed
calendar (``holidays='listed'``, the published behaviour: only listed years
have movable holidays) or are computed for every year from the Gregorian
Easter date (``holidays='computed'``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import vocab as V
from starmart.functions.text import col_


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def weekday_name(d: Column | str) -> Column:
    """Monday-first Portuguese weekday name (ISO day 1..7)."""
    names = F.array(*[F.lit(n) for n in V.WEEKDAYS])
    return F.element_at(names, F.weekday(col_(d)) + 1)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian algorithm), as a DATE."""
    y = year.cast("int")
    a = y % 19
    b = _div(y, 100)
    c = y % 100
    d = _div(b, 4)
    e = b % 4
    f = _div(b + 8, 25)
    g = _div(b - f + 1, 3)
    h = (a * 19 + b - d - g + 15) % 30
    i = _div(c, 4)
    k = c % 4
    l_ = (e * 2 + i * 2 - h - k + 32) % 7
    m = _div(a + h * 11 + l_ * 22, 451)
    n = h + l_ - m * 7 + 114
    return F.make_date(y, _div(n, 31), (n % 31) + 1)


def is_holiday(d: Column | str, holidays: str = "listed") -> Column:
    d = col_(d)
    fixed = None
    for m, day in V.FIXED_HOLIDAYS:
        cond = (F.month(d) == m) & (F.dayofmonth(d) == day)
        fixed = cond if fixed is None else (fixed | cond)
    if holidays == "listed":
        listed = [x for days in V.MOVABLE_HOLIDAYS.values() for x in days]
        movable = d.isin([F.lit(x).cast("date") for x in listed])
    elif holidays == "computed":
        # one Easter evaluation per row: the day offset from Easter decides
        movable = F.date_diff(d, easter_sunday(F.year(d))).isin(V.EASTER_OFFSETS)
    else:
        raise ValueError("holidays must be 'listed' or 'computed'")
    return F.coalesce(fixed | movable, F.lit(False))


def date_parts(d: Column | str) -> dict[str, Column]:
    """day, month, year, quarter (INT) and weekday name of a DATE column."""
    d = col_(d)
    return {
        "dia": F.dayofmonth(d).cast("int"),
        "mes": F.month(d).cast("int"),
        "ano": F.year(d).cast("int"),
        "trimestre": F.quarter(d).cast("int"),
        "dia_semana": weekday_name(d),
    }


def holiday_calendar(spark: SparkSession, years: list[int], holidays: str = "listed") -> DataFrame:
    """The holiday dates of ``years`` as a small DataFrame (date, name-free).

    Built from a ``range`` over the days of the requested years, so it is
    generated on the executors and its size is bounded by 366 x len(years).
    """
    lo, hi = min(years), max(years)
    days = spark.range(0, (hi - lo + 1) * 366).select(
        F.date_add(F.make_date(F.lit(lo), F.lit(1), F.lit(1)), F.col("id").cast("int")).alias("data")
    )
    return days.filter(F.year("data").isin(years) & is_holiday("data", holidays)).select("data")
