"""Guarded text -> number/date parsers.

All parsers are total: bad input never raises, it takes the documented
default.  Regexes are anchored with ``\\z`` because Java's ``$`` also matches
before a final line break.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import col_, py_strip

SQL, FRAME = "sql", "frame"

# The accepted texts of each field.
INT_RE = r"^-?[0-9]+\z"
DECIMAL_RE = r"^-?[0-9]*\.?[0-9]+\z"
# A plain decimal number as a numeric-text converter accepts it: optional sign,
# digits with an optional fraction (or a bare fraction), optional exponent.
NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
KM_FRAME_RE = r"^[0-9]+([,.][0-9]+)?\z"
ISO_DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"

DEC = T.DecimalType(10, 2)


def guarded_int(c: Column | str, default: int) -> Column:
    """SQL rules (F11): NULL -> default; optional '-' and digits -> INT; anything else -> default.

    An out-of-range integer becomes the default instead of an error.
    """
    v = F.coalesce(col_(c), F.lit(str(default)))
    return F.when(v.rlike(INT_RE), F.coalesce(v.try_cast("int"), F.lit(default))).otherwise(F.lit(default)).cast("int")


def guarded_hour(c: Column | str) -> Column:
    """SQL rules for the hour: NULL stays NULL; integer text -> INT; anything else -> 0."""
    c = col_(c)
    return (
        F.when(c.isNull(), F.lit(None).cast("int"))
        .when(c.rlike(INT_RE), F.coalesce(c.try_cast("int"), F.lit(0)))
        .otherwise(F.lit(0))
        .cast("int")
    )


def numeric_text(c: Column | str) -> Column:
    """Frame rules: text -> DOUBLE the way a numeric-text converter reads it (surrounding whitespace allowed), else NULL."""
    v = py_strip(col_(c))
    return F.when(v.rlike(NUMBER_RE), v.try_cast("double"))


def frame_int(c: Column | str, default: int) -> Column:
    """Frame rules (F11): numeric text (``5.0`` and ``1e3`` accepted) truncated toward zero as 64 bits, else default."""
    d = numeric_text(c)
    ok = d.isNotNull() & (F.abs(d) < F.lit(2.0**63))
    return F.when(ok, d.cast("long")).otherwise(F.lit(default)).cast("long")


def decimal_comma(c: Column | str, rules: str = SQL) -> Column:
    """Decimal-comma number.

    sql: ',' -> '.', NULL -> '0'; must match ``-?digits[.digits]`` then
    DECIMAL(10,2) (half-up); no match or overflow -> 0.
    frame: ',' -> '.', numeric text -> DOUBLE, else 0.0 ('1.234,56' -> 0.0).
    """
    if rules == SQL:
        v = F.replace(F.coalesce(col_(c), F.lit("0")), F.lit(","), F.lit("."))
        zero = F.lit(0).cast(DEC)
        return F.when(v.rlike(DECIMAL_RE), F.coalesce(v.try_cast(DEC), zero)).otherwise(zero).cast(DEC)
    v = F.replace(col_(c), F.lit(","), F.lit("."))
    return F.coalesce(numeric_text(v), F.lit(0.0))


def km(c: Column | str, rules: str = SQL) -> Column:
    """Road kilometre.

    sql: integer text only (``12,5`` -> 0), INT.  frame: unsigned number with
    one optional ',' or '.' fraction -> DOUBLE, else 0.0 (``-3`` -> 0.0).
    """
    if rules == SQL:
        return guarded_int(c, 0)
    v = py_strip(col_(c))
    return F.coalesce(F.when(v.rlike(KM_FRAME_RE), F.replace(v, F.lit(","), F.lit(".")).try_cast("double")), F.lit(0.0))


def iso_date(c: Column | str) -> Column:
    """``YYYY-MM-DD`` text -> DATE (F13); other shapes and impossible dates -> NULL."""
    c = col_(c)
    return F.when(c.rlike(ISO_DATE_RE), F.try_to_date(c, "yyyy-MM-dd"))


def mixed_date(c: Column | str, formats: tuple[str, ...] = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")) -> Column:
    """Profiling date parse over a declared format list (F14): first format that parses wins."""
    c = col_(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def hour_number(c: Column | str) -> Column:
    """Profiling (F27): hour text -> DOUBLE or NULL when not numeric."""
    return numeric_text(c)


def out_of_range(c: Column | str, field: str, rules: str = SQL) -> Column:
    """True where well-formed numeric text takes the field's default only because its type cannot hold it."""
    v = col_(c)
    if field == "decimal":
        if rules != SQL:
            return F.lit(False)
        v = F.replace(v, F.lit(","), F.lit("."))
        return F.coalesce(v.rlike(DECIMAL_RE) & v.try_cast(DEC).isNull(), F.lit(False))
    if rules == SQL:
        return F.coalesce(v.rlike(INT_RE) & v.try_cast("int").isNull(), F.lit(False))
    return F.coalesce(F.abs(numeric_text(v)) >= F.lit(2.0**63), F.lit(False))
