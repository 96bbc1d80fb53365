"""Code decoders and category cleaners.

Each takes ``rules='sql'`` (warehouse SQL rules, default) or ``rules='frame'``
(data-frame rules).  The differences are documented per function; all are
pure Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions import vocab as V
from starmart.functions.text import col_, literal_map, py_strip, sql_trim, upper_strip, upper_trim

SQL, FRAME = "sql", "frame"


def _check(rules: str) -> None:
    if rules not in (SQL, FRAME):
        raise ValueError(f"rules must be 'sql' or 'frame', got {rules!r}")


def region(uf: Column | str, default: str = V.NOT_INFORMED, normalise: bool = False) -> Column:
    """State code -> region name (F1).  ``normalise`` strips + upper-cases first (frame rules)."""
    c = upper_strip(uf) if normalise else col_(uf)
    out = None
    for name, states in V.REGIONS.items():
        cond = c.isin(states)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(default))


def region_for(uf: Column | str, rules: str = SQL) -> Column:
    _check(rules)
    if rules == SQL:
        return region(uf, V.NOT_INFORMED)
    return region(uf, V.NOT_INFORMED_FRAME, normalise=True)


def direction(c: Column | str, rules: str = SQL) -> Column:
    """C/D -> Crescente/Decrescente after trim+upper, else the not-informed label (F2)."""
    _check(rules)
    key = upper_trim(c) if rules == SQL else upper_strip(c)
    default = V.NOT_INFORMED if rules == SQL else V.NOT_INFORMED_FRAME
    return literal_map(V.DIRECTIONS, key, default)


def doc_type(c: Column | str, rules: str = SQL) -> Column:
    """Document-type code -> label.

    sql: codes matched after trim+upper; blank -> NÃO INFORMADO; any other
    value is kept as written.  frame: value trimmed and upper-cased, codes
    decoded, blank (or NULL) -> NÃO INFORMADO, anything else kept upper-cased.
    """
    _check(rules)
    c = col_(c)
    if rules == SQL:
        key = upper_trim(c)
        return (
            F.when(key.isin(list(V.DOC_TYPES)), literal_map(V.DOC_TYPES, key))
            .when(sql_trim(c) == F.lit(""), F.lit(V.NOT_INFORMED))
            .otherwise(F.coalesce(c, F.lit(V.NOT_INFORMED)))
        )
    key = upper_strip(c)
    return (
        F.when(key.isin(list(V.DOC_TYPES)), literal_map(V.DOC_TYPES, key))
        .when(c.isNull() | (key == F.lit("")), F.lit(V.NOT_INFORMED))
        .otherwise(key)
    )


def missing_terms(c: Column | str, terms: list[str] = V.MISSING_TERMS, rules: str = FRAME) -> Column:
    """Unify "not informed" spellings (F5): trimmed+upper value in ``terms`` -> NÃO INFORMADO, else the trimmed+upper value.

    NULL -> NÃO INFORMADO (the SQL rules coalesce first; the frame rules have
    no NULLs in a text read, and a missing column is treated as not informed).
    """
    key = upper_trim(c) if rules == SQL else upper_strip(c)
    return F.when(col_(c).isNull() | key.isin(terms), F.lit(V.NOT_INFORMED)).otherwise(key)


def vehicle_type(c: Column | str, rules: str = SQL) -> Column:
    """missing-term unification on the vehicle type."""
    _check(rules)
    return missing_terms(c, V.MISSING_TERMS, rules)


def make(c: Column | str, rules: str = SQL) -> Column:
    """F8: missing-term unification on the make (the SQL list carries one unreachable mis-cased term)."""
    _check(rules)
    return missing_terms(c, V.MISSING_TERMS_MAKE_SQL if rules == SQL else V.MISSING_TERMS, rules)


def species(c: Column | str, rules: str = SQL) -> Column:
    """Vehicle species.

    sql: NULL/blank -> 'Não Informado'; missing terms (plus N/I) ->
    NÃO INFORMADO; unaccented spellings fixed; any other value kept
    upper-cased.  frame: missing terms -> NÃO INFORMADO; unaccented TRACAO /
    COLECAO fixed; only the kept list survives, everything else (blank,
    COMPETICAO, unknown words) -> NÃO INFORMADO.
    """
    _check(rules)
    c = col_(c)
    if rules == SQL:
        key = upper_trim(c)
        fixes = V.SPECIES_ACCENT_FIX
        return (
            F.when(c.isNull() | (sql_trim(c) == F.lit("")), F.lit(V.NOT_INFORMED_SPECIES_BLANK))
            .when(key.isin(V.MISSING_TERMS_SPECIES_SQL), F.lit(V.NOT_INFORMED))
            .when(key.isin(list(fixes)), literal_map(fixes, key))
            .otherwise(key)
        )
    key = upper_strip(c)
    fixes = {k: v for k, v in V.SPECIES_ACCENT_FIX.items() if k != "COMPETICAO"}
    kept = V.SPECIES_KEPT + sorted(set(fixes.values()))
    return (
        F.when(c.isNull() | key.isin(V.MISSING_TERMS), F.lit(V.NOT_INFORMED))
        .when(key.isin(list(fixes)), literal_map(fixes, key))
        .when(key.isin(kept), key)
        .otherwise(F.lit(V.NOT_INFORMED))
    )


def plate_state(c: Column | str, rules: str = SQL) -> Column:
    """Plate state.

    sql: exact match (no trim): a state, N/I or EX is kept; '/', '-1', "'-1"
    and '' -> N/I; a two-character value with a digit -> EX; else N/I.
    frame: trimmed + upper-cased first; any value that is '1' once quotes and
    dashes are removed -> N/I; then the same rules.
    """
    _check(rules)
    c = col_(c)
    keep = V.STATES + [V.NOT_IDENTIFIED_CODE, V.ABROAD_CODE]
    if rules == SQL:
        v = c
        junk = v.isin(V.PLATE_JUNK)
    else:
        v = upper_strip(c)
        junk = (v == F.lit("/")) | (py_strip(F.translate(v, "'-", "")) == F.lit("1"))
    return (
        F.when(v.isin(keep), v)
        .when(junk, F.lit(V.NOT_IDENTIFIED_CODE))
        .when((F.char_length(v) == 2) & v.rlike("[0-9]"), F.lit(V.ABROAD_CODE))
        .otherwise(F.lit(V.NOT_IDENTIFIED_CODE))
    )


def foreign_flag(c: Column | str) -> Column:
    """Foreign-vehicle flag (F10), exact match: S or a neighbour country -> S; N or BR -> N; else N/I.  Same in both rule sets."""
    c = col_(c)
    return (
        F.when(c.isin(V.FOREIGN_YES), F.lit("S"))
        .when(c.isin(V.FOREIGN_NO), F.lit("N"))
        .otherwise(F.lit(V.NOT_IDENTIFIED_CODE))
    )
