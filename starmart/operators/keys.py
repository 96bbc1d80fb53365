"""Dense surrogate keys over a sort order (W1, W2) and dimension builds.

``row_number() over (order by k)`` with no partitioning runs in one task.
Here the rows are range-partitioned and sorted by the key order, each row
gets ``monotonically_increasing_id`` (partition index in the high bits, row
position in the low 33 bits), the numbered rows are written as Parquet to
the shared checkpoint folder so the ids can never change between passes
(even if an executor is lost), and a per-partition row count turns them
into dense keys:

    key = first + rows in earlier partitions + position in partition

The offsets table has one row per partition, so broadcasting it is bounded by
the partition count, not by the data.  The result equals the single-window
``row_number`` exactly (tested).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.joins import broadcast_or_merge
from starmart.session import work_dir

_LOW_BITS = 33
_LOW_MASK = (1 << _LOW_BITS) - 1


@dataclass
class Keyed:
    """A keyed table, its exact row count and its measured size in bytes (for size-checked broadcasts)."""

    df: DataFrame
    rows: int
    bytes: int | None = None
    path: str | None = None  # the folder the numbered rows were written to


def _row_bytes(df: DataFrame, cols: list[str]) -> Column:
    """In-memory width of one row: string/binary bytes as stored, 8-16 bytes per fixed-width value, 16 per row."""
    parts = [F.lit(16)]
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 8)
        elif isinstance(f.dataType, T.DecimalType):
            parts.append(F.lit(16))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(F.lit(128))
        else:
            parts.append(F.lit(8))
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out.cast("long")


def _order_cols(order: list[str | Column], nulls_last: bool) -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, str):
            out.append(F.col(o).asc_nulls_last() if nulls_last else F.col(o).asc_nulls_first())
        else:
            out.append(o)
    return out


def assign_dense_keys(
    df: DataFrame,
    order: list[str | Column],
    sk: str,
    first: int = 1,
    nulls_last: bool = True,
) -> Keyed:
    """Number the rows of ``df`` 1..n (or from ``first``) in ``order``; ``order`` must be a total order on ``df``.

    Ascending orders place NULLs last (the convention of the warehouse SQL).
    """
    spark = df.sparkSession
    cols = df.columns
    path = work_dir(spark, f"keys_{sk}")
    df.orderBy(*_order_cols(order, nulls_last)).withColumn("__mid", F.monotonically_increasing_id()).write.parquet(path)
    ordered = spark.read.parquet(path)
    pid = F.shiftright(F.col("__mid"), _LOW_BITS)
    # one (partition, rows, bytes) triple per partition: bounded by the partition count, not by the data
    per_part = ordered.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)), F.sum(_row_bytes(ordered, cols)))
    counts = sorted((r[0], r[1], r[2] or 0) for r in per_part.collect())
    offsets, running, size = [], 0, 0
    for p_id, n, b in counts:
        offsets.append((p_id, running))
        running += n
        size += b
    total = running
    off_df = spark.createDataFrame(offsets, "__pid long, __off long")
    keyed = ordered.join(F.broadcast(off_df), pid == F.col("__pid"), "inner").select(
        (F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_LOW_MASK)) + F.lit(first)).cast("long").alias(sk),
        *[F.col(c) for c in cols],
    )
    return Keyed(keyed, int(total), int(size), path)


def measured(df: DataFrame) -> tuple[int, int]:
    """Exact rows and in-memory bytes of a table, in one aggregate."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df, df.columns))).first()
    return int(rows), int(size or 0)


def build_dimension(
    df: DataFrame,
    keys: list[str],
    sk: str,
    order: list[str] | None = None,
    first: int = 1,
    attrs_max: dict[str, str] | None = None,
    first_seen: str | None = None,
) -> Keyed:
    """A dimension with a dense surrogate key.

    Without ``attrs_max``: the distinct rows of ``keys`` (G2).  With
    ``attrs_max={out_name: source_col}``: one row per ``keys`` value holding
    the maximum of each attribute (G3, binary string order).  Keys are
    numbered in ``order`` (default: all key columns, making the order total),
    or, with ``first_seen=<orderable column>``, by each value's first
    occurrence in that column's order.
    """
    if first_seen:
        # number the rows by their first occurrence (e.g. file order, then line order)
        aggs = [F.min(first_seen).alias("__first")] + [F.max(src).alias(out) for out, src in (attrs_max or {}).items()]
        base = df.groupBy(*keys).agg(*aggs)
        keyed = assign_dense_keys(base, ["__first"], sk, first=first)
        out_cols = [sk] + keys + list(attrs_max or {})
        return Keyed(keyed.df.select(*out_cols), keyed.rows, keyed.bytes, keyed.path)
    if attrs_max:
        base = df.groupBy(*keys).agg(*[F.max(src).alias(out) for out, src in attrs_max.items()])
    else:
        base = df.select(*keys).distinct()
    keyed = assign_dense_keys(base, order or keys, sk, first=first)
    out_cols = [sk] + keys + list(attrs_max or {})
    return Keyed(keyed.df.select(*out_cols), keyed.rows, keyed.bytes, keyed.path)


def extend_keys(
    known: DataFrame,
    rows: DataFrame,
    keys: list[str],
    sk: str,
    order: list[str] | None = None,
    attrs_max: dict[str, str] | None = None,
    first: int = 1,
) -> Keyed:
    """The dimension rows that ``rows`` add to ``known`` (W1, U3): natural keys it lacks, numbered on from its last key.

    Keys already given never change, whatever order the new values would have had among the old ones.  NULL matches
    NULL.  With ``attrs_max`` a new key takes the maxima of its attributes; the attributes of a known key stay as first
    loaded.  An empty ``known`` starts at ``first``.
    """
    last, n, size = known.agg(F.max(sk), F.count(F.lit(1)), F.sum(_row_bytes(known, known.columns))).first()
    have = known.select(*[F.col(k).alias(f"__known_{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__known_{k}"))
    # whole rows, not distinct ones, would also do: distinct keys cross the shuffle once
    fresh = rows.groupBy(*keys).agg(*[F.max(src).alias(out) for out, src in attrs_max.items()]) if attrs_max else rows.select(*keys).distinct()
    # a broadcast would hold a key three times: itself, beside its NULL flags and as a row
    fresh = fresh.join(broadcast_or_merge(have, n, 3 * (size or 0)), cond, "left_anti")
    keyed = assign_dense_keys(fresh, order or keys, sk, first=first if last is None else last + 1)
    return Keyed(keyed.df.select(sk, *keys, *(attrs_max or {})), keyed.rows, keyed.bytes, keyed.path)
