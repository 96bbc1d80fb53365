"""Size-checked broadcast and null-safe key joins.

A side is broadcast only when its row count is known (the caller passes a
count it already has, e.g. from key assignment) and the estimated size stays
under ``starmart.broadcast.maxBytes``.  Beyond that the join is left to a
shuffle join, where AQE can still switch strategy or split skewed partitions
at runtime.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BYTES = 64 * 1024 * 1024
DEFAULT_MAX_ROWS = 2_000_000
#: Bytes that a broadcast of (hash, surrogate key) holds for a row: two numbers and their place in a half-empty table.
HASHED_ROW = 96


def _width(dt: T.DataType) -> int:
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return 48
    if isinstance(dt, T.DecimalType):
        return 16
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return 128
    return 8


def estimated_bytes(df: DataFrame, rows: int) -> int:
    """Rough in-memory size of ``rows`` rows of ``df``'s schema (per-row overhead included)."""
    return rows * (16 + sum(_width(f.dataType) for f in df.schema.fields))


def can_broadcast(df: DataFrame, rows: int | None, size_bytes: int | None = None) -> bool:
    """True when ``rows`` (exact) and the size (measured ``size_bytes``, else estimated from the schema) pass the limits."""
    if rows is None:
        return False
    conf = df.sparkSession.conf
    max_bytes = int(conf.get("starmart.broadcast.maxBytes", str(DEFAULT_MAX_BYTES)))
    max_rows = int(conf.get("starmart.broadcast.maxRows", str(DEFAULT_MAX_ROWS)))
    size = size_bytes if size_bytes is not None else estimated_bytes(df, rows)
    return rows <= max_rows and size <= max_bytes


def maybe_broadcast(df: DataFrame, rows: int | None, size_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its checked size allows, else ``df`` unchanged."""
    return F.broadcast(df) if can_broadcast(df, rows, size_bytes) else df


def broadcast_or_merge(df: DataFrame, rows: int | None, size_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its checked size allows, else a sort-merge join; unchanged where the rows are not known.

    Spark's own estimate goes by the bytes of compressed files and by the columns taken of them: a written dimension of
    millions of rows would look small to it and be sent through the driver.
    """
    if rows is None:
        return df
    return F.broadcast(df) if can_broadcast(df, rows, size_bytes) else df.hint("merge")


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    on: list[str],
    sk: str,
    dim_rows: int | None = None,
    null_safe: bool = False,
    how: str = "left",
    dim_bytes: int | None = None,
) -> DataFrame:
    """Attach ``dim[sk]`` to ``df`` by natural key ``on`` (J1-J6); the key columns of ``df`` are kept.

    ``null_safe=True`` makes NULL match NULL (``<=>``) without building a
    delimited text key, so values containing the delimiter cannot collide.
    """
    d = dim.select(sk, *[F.col(k).alias(f"__k_{k}") for k in on])
    d = broadcast_or_merge(d, dim_rows, dim_bytes)
    cond = None
    for k in on:
        c = df[k].eqNullSafe(d[f"__k_{k}"]) if null_safe else (df[k] == d[f"__k_{k}"])
        cond = c if cond is None else (cond & c)
    out = df.join(d, cond, how)
    return out.drop(*[f"__k_{k}" for k in on])


def _key_hash(keys: list[Column], null_safe: bool) -> Column:
    """64 bits of a natural key; NULL where the key can match nothing."""
    if null_safe:
        return F.xxhash64(*keys, *[k.isNull() for k in keys])
    known = F.lit(True)
    for k in keys:
        known = known & k.isNotNull()
    return F.when(known, F.xxhash64(*keys))


def lookup_known_keys(df: DataFrame, lookups: list[tuple[DataFrame, list[str], str, int, int | None]], null_safe: bool = False) -> DataFrame:
    """Attach several surrogate keys to rows whose natural keys all are in their dimensions (those were built from them).

    ``lookups``: (dimension, natural key, surrogate key, rows, bytes).  Broadcast lookups go first, they pipeline into
    the scan; shuffle joins last and largest last.  A key of several columns is matched by its 64-bit hash, so that
    neither a broadcast nor the rows crossing the network hold it: a known key's hash leads to its row if no two rows
    of the dimension share a hash, which is tested; else the columns themselves are joined.
    """
    hashed = {}
    for dim, on, sk, _, _ in lookups:
        if len(on) > 1:
            by_hash = dim.select(F.col(sk).alias(f"__of_{sk}"), _key_hash([F.col(k) for k in on], null_safe).alias(f"__hash_of_{sk}")).filter(F.col(f"__hash_of_{sk}").isNotNull())
            if by_hash.groupBy(f"__hash_of_{sk}").count().filter("count > 1").isEmpty():
                hashed[sk] = by_hash
    # what a broadcast would hold: the dimension's measured bytes, or its hashes
    held = {sk: HASHED_ROW * rows if sk in hashed and rows is not None else size for _, _, sk, rows, size in lookups}
    lookups = sorted(lookups, key=lambda t: (not can_broadcast(t[0], t[3], held[t[2]]), t[3]))
    out = df.select("*", *[_key_hash([F.col(k) for k in on], null_safe).alias(f"__hash_{sk}") for _, on, sk, _, _ in lookups if sk in hashed])
    for dim, on, sk, rows, _ in lookups:
        if sk in hashed:
            out = out.join(broadcast_or_merge(hashed[sk], rows, held[sk]), F.col(f"__hash_{sk}") == F.col(f"__hash_of_{sk}"), "left")
            out = out.withColumnRenamed(f"__of_{sk}", sk).drop(f"__hash_{sk}", f"__hash_of_{sk}")
        else:
            out = lookup_key(out, dim, on, sk, rows, null_safe, dim_bytes=held[sk])
    return out


def semi_join(df: DataFrame, other: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows of ``df`` with at least one match in ``other`` (J8, EXISTS).

    ``other`` is reduced to its distinct keys first: the map-side partial
    aggregate collapses a hot key before the shuffle (AQE splits skew only on
    the left side of a semi join), and less data crosses the network.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Rows of ``df`` whose non-NULL key has no match in ``other`` (J9, referential check)."""
    parent = other.select(F.col(right_on).alias("__parent_key")).distinct()
    return df.filter(F.col(left_on).isNotNull()).join(parent, F.col(left_on) == F.col("__parent_key"), "left_anti")
