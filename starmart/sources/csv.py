"""Multi-file delimited ingest into the 25-column raw table.

* **Encoding sniff** (S2-S4), distributed: every file is read as text lines;
  one aggregate per file gives "all lines are valid UTF-8" and the first
  line (the header).  A file is read as UTF-8 when valid, as ISO-8859-1
  otherwise (that decodes any byte), except when its header already holds
  UTF-8 replacement characters: then a Latin-1 decode would show mojibake
  (``ï¿½``) and the file is read as UTF-8 with invalid bytes replaced.
* **Header groups** (U1): a CSV scan binds columns by position, so files are
  grouped by their exact header line (the first non-blank line, as the CSV
  reader takes it) and each group is one scan; the groups are unioned by
  name.  Only per-file metadata (path, encoding, header) ever reaches the
  driver; a header line longer than ``MAX_HEADER_CHARS``, or one that names
  none of the 25 columns, is an error.
* **Quoting**: fields may be quoted with ``"``; a doubled quote inside is one
  quote and a backslash is an ordinary character.
* **Malformed rows** (too many or too few fields) keep the fields that fit
  and carry their whole line in ``registro_malformado`` on request;
  ``malformed_per_file`` counts them.
* **Header reconciliation** (P1-P5): header names are matched to the 25
  storage names ignoring case, surrounding blanks and accents; a U+FFFD in a
  corrupted header matches any one character; Latin-1 mojibake of UTF-8 is
  repaired.  Unknown columns are dropped, missing ones come back NULL.
* Blank fields are kept as ``''`` (a text landing keeps no NULLs); NULL
  therefore only marks a column the file did not have.
"""

from __future__ import annotations

import csv
import re
import unicodedata
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import RAW_COLUMNS, RAW_COLUMNS_AND_HEADERS

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"
REPLACEMENT = "�"
MALFORMED = "registro_malformado"
MAX_HEADER_CHARS = 100_000
QUOTING = {"quote": '"', "escape": '"'}  # a doubled quote is one quote; a backslash is itself


def _fold(s: str) -> str:
    """lower-case, trimmed, accents removed, inner blanks collapsed (a byte-order mark is ignored)."""
    s = unicodedata.normalize("NFD", s.replace("\ufeff", "").strip().lower())
    s = "".join(ch for ch in s if not unicodedata.combining(ch))
    return re.sub(r"\s+", " ", s)


_CANON: dict[str, str] = {}
for _name, _header in RAW_COLUMNS_AND_HEADERS:
    _CANON[_fold(_header)] = _name
    _CANON[_fold(_name.replace("_", " "))] = _name
    _CANON[_name] = _name


def _repair_mojibake(h: str) -> str:
    try:
        fixed = h.encode("latin-1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return h
    return fixed


def resolve_header(h: str) -> str | None:
    """Storage name of a source header, or None when it is not one of the 25 columns."""
    for cand in (h, _repair_mojibake(h)):
        key = _fold(cand.replace(REPLACEMENT, "\x00"))
        if key in _CANON:
            return _CANON[key]
        if "\x00" in key:
            pattern = re.compile("".join("." if ch == "\x00" else re.escape(ch) for ch in key))
            hits = {v for k, v in _CANON.items() if pattern.fullmatch(k)}
            if len(hits) == 1:
                return hits.pop()
    return None


@dataclass
class SniffedFile:
    path: str
    valid_utf8: bool
    header_has_replacement: bool
    header_line: str
    header_bytes: bytes = b""

    @property
    def encoding(self) -> str:
        return UTF8 if (self.valid_utf8 or self.header_has_replacement) else LATIN1

    def header(self, sep: str) -> list[str]:
        """Names in the header line, decoded with the file's encoding; the reader's own header is not used, which may be a blank line."""
        text = self.header_bytes.decode("latin-1" if self.encoding == LATIN1 else "utf-8", errors="replace")
        return next(csv.reader([text], delimiter=sep), [])


def not_blank(line: str) -> Column:
    """True for a line with any character above the space; tabs and other control characters alone make it blank."""
    return F.col(line).rlike(r"[^\x00-\x20]")


def column_places(header: list[str], path: str) -> dict[str, int]:
    """Place of each known column in a header; the first of two that name the same column counts.  None known is an error."""
    places: dict[str, int] = {}
    for i, h in enumerate(header):
        name = resolve_header(h)
        if name and name not in places:
            places[name] = i
    if not places:
        raise ValueError(f"no known column in the header of {path}: {header[:5]}")
    return places


def text_lines(spark: SparkSession, paths: list[str] | str, recursive: bool = False, pattern: str = "*.csv") -> DataFrame:
    """(value, file_path, block_start) of every line; ``recursive=True`` takes every file matching ``pattern`` under the given folders."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start")
    )


def sniff_files(spark: SparkSession, paths: list[str] | str, recursive: bool = False, pattern: str = "*.csv") -> DataFrame:
    """(file_path, valid_utf8, header_has_replacement, header_line) per file, computed on the executors."""
    lines = text_lines(spark, paths, recursive, pattern)
    # the header is the first non-blank line; splits follow their start, and ids grow in line order inside a split
    place = F.struct("block_start", F.monotonically_increasing_id())
    lines = lines.withColumn("__ord", F.when(not_blank("value"), place))
    cut = F.substring("value", 1, MAX_HEADER_CHARS + 1)  # never more than this of a line reaches the driver
    return lines.groupBy("file_path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("valid_utf8"),
        F.min_by(cut, "__ord").alias("header_line"),
        F.min_by(cut.cast("binary"), "__ord").alias("header_bytes"),
    ).withColumn("header_has_replacement", F.col("header_line").contains(REPLACEMENT))


def _file_list(spark: SparkSession, paths: list[str] | str, recursive: bool = False, pattern: str = "*.csv") -> list[SniffedFile]:
    rows = sniff_files(spark, paths, recursive, pattern).collect()  # one small row per file
    long_ = [r["file_path"] for r in rows if len(r["header_line"] or "") > MAX_HEADER_CHARS]
    if long_:
        raise ValueError(f"header longer than {MAX_HEADER_CHARS} characters in {long_[:5]}")
    return [SniffedFile(r["file_path"], bool(r["valid_utf8"]), bool(r["header_has_replacement"]), r["header_line"] or "", bytes(r["header_bytes"] or b"")) for r in rows]


def read_raw(
    spark: SparkSession,
    paths: list[str] | str,
    sep: str = ";",
    with_source: bool = True,
    multiline: bool = False,
    with_position: bool = False,
    recursive: bool = False,
    pattern: str = "*.csv",
    with_malformed: bool = False,
) -> DataFrame:
    """Read delimited files with varying encodings and headers into RAW (+ ``source_file``).

    ``with_malformed=True`` adds ``registro_malformado``: the whole line of a
    row whose field count differs from its header's, else NULL.

    ``with_position=True`` adds ``source_position``, a struct (file path,
    split start, row id within the split) taken in the scan's own stage:
    ordering by it gives file order, then line order inside each file, which
    the frame rules use for first-seen key numbering.

    ``multiline=True`` accepts quoted fields that contain line breaks; each
    file is then read by one task (it cannot be split), so leave it off for
    large files without such fields.
    """
    files = _file_list(spark, paths, recursive, pattern)
    groups: dict[tuple[str, bytes], list[SniffedFile]] = defaultdict(list)
    for f in files:
        if f.header_bytes:  # a file of blank lines has neither header nor rows
            groups[(f.encoding, f.header_bytes)].append(f)
    out = None
    for (enc, _header), group in sorted(groups.items(), key=lambda g: g[0]):
        group_paths = sorted(f.path for f in group)
        header = group[0].header(sep)
        places = column_places(header, group_paths[0])
        reader = (
            spark.read.options(**QUOTING)
            .option("sep", sep)
            .option("header", True)
            .option("encoding", enc)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED)
            .option("columnPruning", not with_malformed and not multiline)  # a pruned parse does not count a row's fields
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("multiLine", multiline)
        )
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
        if with_malformed:
            fields.append(T.StructField(MALFORMED, T.StringType()))
        df = reader.schema(T.StructType(fields)).csv(group_paths)
        cols = [F.coalesce(F.col(f"c{i}"), F.lit("")).alias(name) for name, i in places.items()]
        if with_malformed:
            cols.append(F.col(MALFORMED))
        if with_source:
            cols.append(F.col("_metadata.file_path").alias("source_file"))
        if with_position:
            cols.append(
                F.struct(
                    F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),  # increases with the line order inside a split
                ).alias("source_position")
            )
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no input files under {paths!r}")
    present = set(out.columns)
    final = [F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
    if with_malformed:
        final.append(F.col(MALFORMED))
    if with_source:
        final.append(F.col("source_file"))
    if with_position:
        final.append(F.col("source_position"))
    return out.select(*final)


def malformed_per_file(raw: DataFrame, key: str = "numero_auto") -> DataFrame:
    """(source_file, rows, malformed, with_key) of rows read with ``with_malformed`` and ``with_source``; with_key: a non-blank ``key``."""
    return raw.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.count(MALFORMED).alias("malformed"), F.count_if(F.col(key) != "").alias("with_key")
    )


def source_year(file_col: str = "source_file") -> "F.Column":
    """The 4-digit year folder a file sits in (``.../2023/file.csv`` -> 2023), else NULL."""
    y = F.regexp_extract(F.col(file_col), r"/([0-9]{4})/[^/]*$", 1)
    return F.when(y != "", y.cast("int"))


def first_file_columns(spark: SparkSession, paths: list[str] | str, sep: str = ";") -> list[str]:
    """Header names of the first file in name order, decoded with its sniffed encoding."""
    files = sorted(_file_list(spark, paths), key=lambda f: f.path)
    if not files:
        return []
    return files[0].header(sep)


def write_csv_batches(df: DataFrame, path: str, headers: list[str], encoding: str = UTF8, sep: str = ";") -> None:
    """Write ``df`` (columns in RAW order, any subset) as delimited text files with the given header names."""
    out = df.toDF(*headers)
    (
        out.write.mode("overwrite")
        .options(**QUOTING)
        .option("sep", sep)
        .option("header", True)
        .option("encoding", encoding)
        # the writer trims values by default; a raw landing must keep them as they are
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
