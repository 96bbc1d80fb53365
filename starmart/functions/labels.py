"""Chart-ready labels and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions import vocab as V
from starmart.functions.text import col_, literal_map


def millions(c: Column | str) -> Column:
    """Scale a count to millions (DOUBLE)."""
    return col_(c).cast("double") / F.lit(1_000_000.0)


def code_label(code: Column | str, text: Column | str, width: int = V.LABEL_PREFIX_CHARS) -> Column:
    """'[code] ' + first ``width`` characters of ``text`` + '...'."""
    return F.concat(F.lit("["), col_(code).cast("string"), F.lit("] "), F.substring(col_(text), 1, width), F.lit("..."))


def pair_label(a: Column | str, b: Column | str, sep: str = " / ") -> Column:
    return F.concat(col_(a), F.lit(sep), col_(b))


def thousands(c: Column | str) -> Column:
    """Integer with ',' thousands separators, e.g. 1,234,567."""
    return F.format_number(col_(c).cast("double"), 0)


def dot_thousands(c: Column | str) -> Column:
    """Integer with '.' thousands separators, e.g. 1.234.567."""
    return F.translate(thousands(c), ",", ".")


def signed_percent(c: Column | str, decimals: int = 1) -> Column:
    """'+12.3%' for positive values, '-4.0%' / '0.0%' otherwise (value rounded exactly to ``decimals``)."""
    v = col_(c).cast(f"decimal(20,{decimals})")
    body = F.concat(v.cast("string"), F.lit("%"))
    return F.when(v > 0, F.concat(F.lit("+"), body)).otherwise(body)


def millions_label(c: Column | str, decimals: int = 1) -> Column:
    """'13.2M' from an integer count (exact half-away rounding, no binary-float ties)."""
    from starmart.functions.rounding import round_ratio

    return F.concat(round_ratio(col_(c), F.lit(1_000_000), decimals).cast("string"), F.lit("M"))


def colour(key: Column | str, palette: dict[str, str], default: str = V.DEFAULT_COLOUR) -> Column:
    """Category -> colour with a default."""
    return literal_map(palette, key, default)
