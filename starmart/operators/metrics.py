"""Report metrics over grouped tables.

These run on aggregated rows.  Partitioned windows (change vs previous) are
distributed by their partition keys.  The grand total for a share is a scalar
subquery (one value computed by a distributed aggregate), not a
single-partition window.  Ranking keeps only the top ``k`` rows before
numbering them, so no step sorts all groups in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.rounding import round_percent, round_ratio


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def share_of_total(df: DataFrame, value: str, out: str = "pct_do_total", scale: int = 2) -> DataFrame:
    """Add ``out`` = round(100 * value / sum(value over all rows), scale)."""
    total = df.select(F.sum(value)).scalar()
    # bind the subquery once; the rounding formula then reads the column
    with_total = df.withColumn("__total", total)
    return with_total.withColumn(out, round_percent(F.col(value), F.col("__total"), scale)).drop("__total")


def change_vs_previous(
    df: DataFrame,
    by: list[str],
    order: list[str | Column],
    value: str,
    out: str,
    kind: str = "abs",
    scale: int = 2,
) -> DataFrame:
    """Change of ``value`` against the previous row of its ``by`` partition in ``order``.

    ``kind='abs'``: value - previous.  ``kind='pct'``: round(100 * (value -
    previous) / previous, scale), NULL when previous is 0 or absent.  The
    previous *row* is used, even if a period is missing in between.
    """
    w = Window.partitionBy(*by).orderBy(*[_c(o) for o in order])
    prev = F.lag(value).over(w)
    if kind == "abs":
        return df.withColumn(out, F.col(value) - prev)
    if kind == "pct":
        return df.withColumn(out, round_ratio((F.col(value) - prev) * 100, prev, scale))
    raise ValueError("kind must be 'abs' or 'pct'")


def top_k(df: DataFrame, order: list[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order`` (K2-K4); give a total order for a deterministic result."""
    return df.orderBy(*[_c(o) for o in order]).limit(k)


def rank_by(df: DataFrame, order: list[str | Column], k: int, out: str = "ranking") -> DataFrame:
    """Number the top ``k`` rows 1..k in ``order`` (W6 + P12)."""
    top = top_k(df, order, k)
    return top.withColumn(out, F.row_number().over(Window.orderBy(*[_c(o) for o in order])).cast("long"))


def pivot_change(
    df: DataFrame,
    index: str | list[str],
    column: str,
    values: list,
    value: str,
    base,
    target,
    out: str = "var_pct",
    scale: int = 1,
) -> DataFrame:
    """Roll ``value`` up by (index, column), pivot ``column`` to the given ``values`` and add the % change base -> target.

    Missing cells are NULL (``fill`` them with ``na.fill(0)``, G12).  Explicit
    pivot values avoid a distinct pass and fix the schema.
    """
    index = [index] if isinstance(index, str) else list(index)
    wide = df.groupBy(*index).pivot(column, values).agg(F.sum(value))
    wide = wide.toDF(*index, *[str(v) for v in values])
    b, t = F.col(str(base)), F.col(str(target))
    return wide.withColumn(out, round_ratio((t - b) * 100, b, scale))


def stack_base(df: DataFrame, by: list[str], category: str, order: list[str] | str, value: str, out: str = "base") -> DataFrame:
    """Running total of ``value`` over the categories before each row.

    ``order`` is either a fixed list of category values (rows whose category
    is not listed are dropped: they are not stacked) or the name of a column
    that orders the categories.
    """
    if isinstance(order, str):
        pos = F.col(order)
        keep = F.lit(True)
    else:
        pos = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(category))
        keep = pos > 0
    w = Window.partitionBy(*by).orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("__pos", pos)
        .filter(keep)
        .withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
        .drop("__pos")
    )
