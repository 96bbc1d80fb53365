"""Text primitives shared by both rule sets.

The SQL rule set trims spaces only (SQL ``trim``).  The frame rule set strips
every character Python's ``str.strip()`` strips; that set is derived from the
Unicode database at import time rather than written out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.vocab import NOT_INFORMED

# Every code point for which str.isspace() holds (what str.strip() removes).
PY_WHITESPACE: str = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_trim(c: Column | str) -> Column:
    """SQL trim: leading/trailing spaces only."""
    return F.trim(col_(c))


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: leading/trailing Unicode whitespace."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def upper_trim(c: Column | str) -> Column:
    return F.upper(sql_trim(c))


def upper_strip(c: Column | str) -> Column:
    return F.upper(py_strip(c))


def null_default(c: Column | str, default: str = NOT_INFORMED) -> Column:
    """NULL -> default; blank text is kept (SQL rule set)."""
    return F.coalesce(col_(c), F.lit(default))


def blank_default(c: Column | str, default: str = NOT_INFORMED) -> Column:
    """NULL or exactly '' -> default (frame rule set; no trimming)."""
    c = col_(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(default)).otherwise(c)


def literal_map(mapping: dict, key: Column | str, default: Column | str | None = None) -> Column:
    """Look a value up in a small literal map (exact match)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    # try_element_at: a missing key gives NULL instead of an error under ANSI mode
    out = F.try_element_at(F.create_map(*pairs), col_(key))
    if default is None:
        return out
    return F.coalesce(out, F.lit(default) if isinstance(default, str) else default)
