"""Column profiling (C8-C10, G13-G18, F14, F26, F27) as long tables.

All metrics are distributed aggregates: one pass with one conditional count
per column for null profiles, ``groupBy`` for duplicates / value counts /
top values (partial aggregation absorbs hot values), and only small metric
rows leave the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import vocab as V
from starmart.functions.parse import hour_number, mixed_date
from starmart.functions.rounding import round_percent
from starmart.functions.text import upper_strip


def profile_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, nulls, pct) for columns with at least one NULL, pct = round(100*nulls/rows, 2)."""
    cols = columns or df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(cols)],
    )
    stack = F.inline(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").cast("long").alias("nulls")) for i, c in enumerate(cols)])
    )
    long = agg.select("__rows", stack)
    out = long.filter(F.col("nulls") > 0).select(
        "column_name", "nulls", round_percent(F.col("nulls"), F.col("__rows"), 2).alias("pct")
    )
    return out.orderBy(F.col("pct").desc(), "column_name")


def profile_dates(df: DataFrame, column: str, year: int | Column | None = None, formats: tuple[str, ...] | None = None) -> DataFrame:
    """(metric, value): dates that are invalid or NULL, and valid dates outside ``year``."""
    d = mixed_date(column, formats) if formats else mixed_date(column)
    aggs = [F.count_if(d.isNull()).cast("long").alias("invalid_or_null")]
    if year is not None:
        want = year if isinstance(year, Column) else F.lit(year)
        aggs.append(F.count_if(d.isNotNull() & (F.year(d) != want)).cast("long").alias("outside_year"))
    return _metrics(df.agg(*aggs))


def profile_hours(df: DataFrame, column: str, lo: int = V.HOUR_RANGE[0], hi: int = V.HOUR_RANGE[1]) -> DataFrame:
    """(metric, value): hour values that are not numeric, and numeric ones outside [lo, hi]."""
    h = hour_number(column)
    return _metrics(
        df.agg(
            F.count_if(h.isNull()).cast("long").alias("not_numeric"),
            F.count_if((h < lo) | (h > hi)).cast("long").alias("out_of_range"),
        )
    )


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key value was already seen (NULL equals NULL), as one (metric, value) row."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return _metrics(per_key.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicated_keys")))


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, count, unique, top, freq) per text column (G16); ``top`` ties go to the smallest value.

    One scan: the columns are stacked as (column, value) and counted by one
    grouped aggregate; the summaries are further distributed aggregates over
    those counts (no window, so no column's values gather in one task).
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("__v")) for c in columns]))
    counts = df.select(pairs).filter(F.col("__v").isNotNull()).groupBy("column_name", "__v").agg(F.count(F.lit(1)).alias("__n"))
    summary = counts.groupBy("column_name").agg(
        F.sum("__n").cast("long").alias("count"),
        F.count(F.lit(1)).cast("long").alias("unique"),
        F.max("__n").cast("long").alias("freq"),
    )
    # one row per column: a bounded broadcast
    tops = (
        counts.join(F.broadcast(summary.select("column_name", "freq")), "column_name")
        .filter(F.col("__n") == F.col("freq"))
        .groupBy("column_name")
        .agg(F.min("__v").alias("top"))
    )
    return summary.join(F.broadcast(tops), "column_name").select("column_name", "count", "unique", "top", "freq")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value) for the distinct non-NULL values of each column (G17), sorted."""
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(stack).filter(F.col("value").isNotNull()).distinct().orderBy("column_name", "value")


def term_counts(df: DataFrame, column: str, terms: list[str]) -> DataFrame:
    """Counts of a column's trimmed, upper-cased values restricted to ``terms``."""
    v = upper_strip(column)
    return df.filter(v.isin(terms)).groupBy(v.alias("value")).agg(F.count(F.lit(1)).cast("long").alias("n"))


def changed_values(df: DataFrame, before: str, after: str) -> DataFrame:
    """(before, after, n): how a rule mapped each input value."""
    return df.groupBy(F.col(before).alias("before"), F.col(after).alias("after")).agg(F.count(F.lit(1)).cast("long").alias("n"))


def rows_per_source(df: DataFrame, source_col: str = "source_file") -> DataFrame:
    """Row totals per input file."""
    return df.groupBy(source_col).agg(F.count(F.lit(1)).cast("long").alias("rows"))


def _metrics(one_row: DataFrame) -> DataFrame:
    cols = one_row.columns
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in cols]))
    return one_row.select(stack)


def _rows_up_to(df: DataFrame, group: list[str], key: str, n: int) -> DataFrame:
    """Rows of each group whose key is not above its n-th smallest (all of a group with fewer keys than that)."""
    by_key = Window.partitionBy(*group).orderBy(F.col(key).asc_nulls_last())
    last = df.select(*[F.col(g).alias(f"__{g}") for g in group], F.col(key).alias("__last"), F.row_number().over(by_key).alias("__i"))
    last = last.filter((F.col("__i") == n) & F.col("__last").isNotNull()).drop("__i")  # one row per group
    if not group:
        found = last.first()
        return df.filter(F.col(key) <= F.lit(found["__last"])) if found else df
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    # one row per group of n keys or more; joined by a shuffle, each group's whole rows would gather in one task
    return df.join(F.broadcast(last), same, "left").filter(F.col("__last").isNull() | (F.col(key) <= F.col("__last"))).select(*df.columns)


def profile(
    df: DataFrame,
    date_col: str | None = None,
    year: int | Column | None = None,
    hour_col: str | None = None,
    key_col: str | None = None,
    text_cols: list[str] | None = None,
    value_cols: list[str] | None = None,
    sample_cols: list[str] | None = None,
    by: str | None = None,
    date_samples: int = 5,
    row_samples: int = 50,
) -> DataFrame:
    """All profiling sections as one long table ([by,] section, column_name, metric, value as text).

    ``by``: a column (e.g. the load year) whose values are profiled apart;
    ``year``: the year dates should have, a number or a column of ``df``.
    Null counts, date and hour validity come from one aggregate pass.
    Duplicates, text summaries and distinct values share a second pass: the
    columns are stacked as (column, value) and counted by one grouped
    aggregate.  Samples are the first rows in key order, so they are the same
    in every run: the last key of each group's sample is found over the keys alone, and only rows up to it are sorted.
    """
    group = [by] if by else []
    cols = [c for c in df.columns if c != by]
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(cols)]
    rows = []
    for i, c in enumerate(cols):
        n = F.col(f"n_{i}")
        keep = n > 0
        rows.append((keep, "nulls", c, "nulls", n.cast("string")))
        rows.append((keep, "nulls", c, "pct", round_percent(n, F.col("__rows"), 2).cast("string")))
    if date_col:
        d = mixed_date(date_col)
        aggs.append(F.count_if(d.isNull()).alias("d_bad"))
        rows.append((F.lit(True), "dates", date_col, "invalid_or_null", F.col("d_bad").cast("string")))
        if year is not None:
            want = year if isinstance(year, Column) else F.lit(year)
            aggs.append(F.count_if(d.isNotNull() & (F.year(d) != want)).alias("d_out"))
            rows.append((F.lit(True), "dates", date_col, "outside_year", F.col("d_out").cast("string")))
    if hour_col:
        h = hour_number(hour_col)
        aggs += [F.count_if(h.isNull()).alias("h_bad"), F.count_if((h < V.HOUR_RANGE[0]) | (h > V.HOUR_RANGE[1])).alias("h_out")]
        rows.append((F.lit(True), "hours", hour_col, "not_numeric", F.col("h_bad").cast("string")))
        rows.append((F.lit(True), "hours", hour_col, "out_of_range", F.col("h_out").cast("string")))
    one = df.groupBy(*group).agg(*aggs)
    structs = F.array(*[
        F.struct(keep.alias("keep"), F.lit(sec).alias("section"), F.lit(c).alias("column_name"), F.lit(m).alias("metric"), v.alias("value"))
        for keep, sec, c, m, v in rows
    ])
    out = one.select(*group, F.inline(structs)).filter("keep").drop("keep")

    roles = [("duplicates", key_col)] if key_col else []
    roles += [("describe", c) for c in text_cols or []] + [("values", c) for c in value_cols or []]
    if roles:
        pairs = F.array(*[F.struct(F.lit(r).alias("section"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("__v")) for r, c in roles])
        counts = df.select(*group, F.inline(pairs)).groupBy(*group, "section", "column_name", "__v").agg(F.count(F.lit(1)).alias("__n"))
        known = F.col("__v").isNotNull()
        # the most frequent value, ties to the smallest: the largest (count, then least value) pair, without a window
        best = counts.groupBy(*group, "section", "column_name").agg(
            F.sum(F.col("__n") - 1).alias("again"), F.sum(F.when(known, F.col("__n"))).alias("count"), F.count("__v").alias("unique"),
            F.max(F.when(known, F.col("__n"))).alias("freq"),
            F.min_by("__v", F.when(known, F.struct(-F.col("__n"), F.col("__v")))).alias("top"),
        )
        metrics = F.array(*[
            F.struct((F.col("section") == sec).alias("keep"), F.lit(m).alias("metric"), F.col(c).cast("string").alias("value"))
            for sec, m, c in (("duplicates", "duplicated_keys", "again"), *[("describe", m, m) for m in ("count", "unique", "top", "freq")])
        ])
        told = best.select(*group, "section", "column_name", F.inline(metrics)).filter("keep").drop("keep")
        values = counts.filter((F.col("section") == "values") & known).select(*group, "section", "column_name", F.lit("value").alias("metric"), F.col("__v").alias("value"))
        out = out.unionByName(told).unionByName(values)
    if sample_cols and key_col:
        order = Window.partitionBy(*group).orderBy(F.col(key_col).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in cols if c != key_col])
        near = _rows_up_to(df, group, key_col, max(date_samples, row_samples))
        first = near.select(*group, *cols, F.row_number().over(order).alias("__i")).filter(F.col("__i") <= max(date_samples, row_samples))
        picks = [(date_col, mixed_date(date_col).cast("string"), date_samples)] if date_col else []
        picks += [(c, F.col(c).cast("string"), row_samples) for c in sample_cols]
        parts = F.array(*[F.struct((F.col("__i") <= n).alias("keep"), F.lit("sample").alias("section"), F.lit(c).alias("column_name"),
                                   F.format_string("%03d", F.col("__i")).alias("metric"), v.alias("value")) for c, v, n in picks])
        out = out.unionByName(first.select(*group, F.inline(parts)).filter("keep").drop("keep"))
    return out
