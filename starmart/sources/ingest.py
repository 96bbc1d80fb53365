"""One-pass ingest: the bytes of the files are read once.

The lines land as they are (bytes, file, place) in the shared folder; whether a file is valid UTF-8 and which line is
its header are aggregates over the landed lines.  Encoding and layout of each file are joined back to its lines, and
every line is decoded and parsed by one expression, whatever its file's layout: a hundred header layouts are one plan,
not a hundred scans.  Encodings, headers, quoting, malformed rows and blank lines follow ``sources.csv``.
"""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.joins import maybe_broadcast
from starmart.schemas import RAW_COLUMNS
from starmart.session import work_dir
from starmart.sources.csv import LATIN1, MALFORMED, MAX_HEADER_CHARS, QUOTING, REPLACEMENT, column_places, not_blank, text_lines

_FILE = "file_path string, latin boolean, head_block long, head_row long, fields int, places array<int>"


def land_lines(spark: SparkSession, paths: list[str] | str, recursive: bool = False, pattern: str = "*.csv") -> DataFrame:
    """The non-blank lines of the files, written once: file_path, block, row, valid, line (bytes as they stand in the file)."""
    lines = text_lines(spark, paths, recursive, pattern).filter(not_blank("value")).select(
        "file_path", F.col("block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
        F.is_valid_utf8("value").alias("valid"), F.col("value").cast("binary").alias("line"),
    )
    path = work_dir(spark, "landed_lines")
    lines.write.parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def describe_files(landed: DataFrame) -> list[dict]:
    """Encoding, header place and header fields of each landed file; one small row per file reaches the driver."""
    place = F.struct("block", "row")
    rows = landed.groupBy("file_path").agg(
        F.bool_and("valid").alias("valid"), F.min(place).alias("head"),
        F.min_by(F.substring("line", 1, 4 * MAX_HEADER_CHARS + 1), place).alias("header"),
    ).collect()
    out = []
    for r in sorted(rows, key=lambda r: r["file_path"]):
        if len(r["header"]) > 4 * MAX_HEADER_CHARS:
            raise ValueError(f"header longer than {MAX_HEADER_CHARS} characters in {r['file_path']}")
        as_utf8 = bytes(r["header"]).decode("utf-8", errors="replace")
        # a header that already holds replacement characters was UTF-8 once: a Latin-1 decode would show mojibake
        latin = not r["valid"] and REPLACEMENT.encode() not in bytes(r["header"])
        out.append({"file_path": r["file_path"], "latin": latin, "head": r["head"], "header": bytes(r["header"]).decode("latin-1") if latin else as_utf8})
    return out


def field_count(line: Column, sep: str) -> Column:
    """Fields of a line: separators outside quoted fields, and one."""
    s = re.escape(sep)
    bare = F.when(line.contains('"'), F.regexp_replace(line, f'(^|{s})"(?:[^"]|"")*"(?={s}|\\z)', "$1")).otherwise(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def read_once(
    spark: SparkSession,
    paths: list[str] | str,
    sep: str = ";",
    with_source: bool = True,
    with_position: bool = False,
    recursive: bool = False,
    pattern: str = "*.csv",
    with_malformed: bool = False,
) -> DataFrame:
    """RAW (+ ``source_file``, ``source_position``, ``registro_malformado`` on request) as ``read_raw`` gives it, in one scan of the files.

    Quoted line breaks need ``read_raw(multiline=True)``.  A file none of whose header names is known is an error.
    """
    landed = land_lines(spark, paths, recursive, pattern)
    known = describe_files(landed)
    if not known:
        raise ValueError(f"no lines under {paths!r}")
    files, width = [], 1
    for f in known:
        header = next(csv.reader([f["header"]], delimiter=sep))
        places = column_places(header, f["file_path"])
        width = max(width, len(header))
        files.append((f["file_path"], f["latin"], f["head"]["block"], f["head"]["row"], len(header), [places.get(c) for c in RAW_COLUMNS]))
    table = spark.createDataFrame(files, _FILE)
    size = sum(400 + len(f[0]) for f in files)
    lines = landed.join(maybe_broadcast(table, len(files), size), "file_path").filter((F.col("block") != F.col("head_block")) | (F.col("row") != F.col("head_row")))
    raw = F.col("line").cast("string")
    text = F.when(F.col("latin"), F.decode("line", LATIN1)).when(F.col("valid"), raw).otherwise(F.make_valid_utf8(raw))
    options = {**QUOTING, "sep": sep, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    parsed = lines.withColumn("text", text).withColumn("cells", F.from_csv("text", ", ".join(f"c{i} STRING" for i in range(width)), options))
    parsed = parsed.withColumn("cells", F.array(*[F.col(f"cells.c{i}") for i in range(width)]))
    cols = []
    for i, c in enumerate(RAW_COLUMNS):
        at = F.get("places", F.lit(i))
        cols.append(F.when(at.isNotNull(), F.coalesce(F.get("cells", at), F.lit(""))).alias(c))
    if with_malformed:
        cols.append(F.when(field_count(F.col("text"), sep) != F.col("fields"), F.col("text")).alias(MALFORMED))
    if with_source:
        cols.append(F.col("file_path").alias("source_file"))
    if with_position:
        cols.append(F.struct(F.col("file_path").alias("file"), "block", "row").alias("source_position"))
    return parsed.select(*cols)
