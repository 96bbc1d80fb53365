"""Distinct rows of a written table of wide text rows, without moving the rows.

A row is known by the SHA-256 of its values, each with its length, so that no two different rows have the same text.
Only digests and places (file, row in it) cross the network; the first place of each digest is marked in a bitmap of
one bit per row, and the rows are read a second time through the bitmaps, which are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.joins import can_broadcast
from starmart.session import work_dir, write_settings

_BITS = 32_768  # rows of a file that Spark's bitmap functions mark in one bitmap
_ROW_BITS = 40  # of a place; the number of the file stands above them
_BITMAP_BYTES = _BITS // 8 + 64


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row's texts, NULL and empty ones told apart."""
    cells = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat(*cells), 256))


def distinct_written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``spark.read.schema(schema).parquet(path).distinct()`` for a table of text columns.

    Where the bitmaps would be too large to broadcast, or a column is no text, all rows are compared.
    """
    rows = spark.read.schema(schema).parquet(path)
    if not rows.columns or any(not isinstance(f.dataType, T.StringType) for f in schema.fields):
        return rows.distinct()
    found = rows.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per file
    bitmaps = sum(-(-r["n"] // _BITS) for r in found)
    if not can_broadcast(rows, bitmaps, _BITMAP_BYTES * bitmaps):
        return rows.distinct()
    files = spark.createDataFrame([(r["file"], i) for i, r in enumerate(found)], "__path string, __number long")
    place = F.shiftleft("__number", _ROW_BITS) + F.col("__row")
    placed = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    placed = placed.join(F.broadcast(files), F.col("__file") == F.col("__path")).select(*rows.columns, (place + 1).alias("__place"))

    # dealt out before they are grouped: digests hardly repeat within a task, whose table of them would spill
    first = placed.select(row_digest(rows.columns).alias("digest"), "__place").repartition("digest").groupBy("digest").agg(F.min("__place").alias("at"))
    marked = first.select(F.bitmap_bucket_number("at").alias("__bucket"), F.bitmap_bit_position("at").alias("bit")).repartition("__bucket")
    kept = work_dir(spark, "first_places")
    with write_settings(spark):
        marked.groupBy("__bucket").agg(F.bitmap_construct_agg("bit").alias("__bits")).write.parquet(kept)

    bit = F.bitmap_bit_position("__place")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.broadcast(spark.read.schema("__bucket long, __bits binary").parquet(kept))
    alone = placed.join(held, F.bitmap_bucket_number("__place") == F.col("__bucket"))
    return alone.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*rows.columns)
