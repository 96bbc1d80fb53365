"""End-to-end load: delimited files -> RAW -> PREPARED -> star, then the reports, all written to a target folder.

This is the whole warehouse run as Spark jobs: one ingest plan over all
files (no per-month loop), the chosen rule set, the star build and one
Parquet folder per table and per report.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from starmart.plans.prepare import normalize
from starmart.plans.reports import REPORTS
from starmart.plans.star import Star, build_star, write_star
from starmart.sources.csv import read_raw
from starmart.sources.ingest import read_once
from starmart.sources.sinks import write_table


def load_warehouse(
    spark: SparkSession,
    paths: list[str] | str,
    target_dir: str | None = None,
    rules: str = "sql",
    holidays: str = "listed",
    sep: str = ";",
    multiline: bool = False,
    recursive: bool = False,
) -> Star:
    """Ingest the files, clean them under ``rules``, build the star and (optionally) write it under ``target_dir``."""
    # the frame rules number keys by first occurrence, so rows keep their file position
    if multiline:
        raw = read_raw(spark, paths, sep=sep, with_source=False, multiline=True, with_position=(rules == "frame"), recursive=recursive)
    else:
        raw = read_once(spark, paths, sep=sep, with_source=False, with_position=(rules == "frame"), recursive=recursive)
    star = build_star(normalize(raw, rules, holidays), rules, holidays)
    if target_dir:
        write_star(star, target_dir)
    return star


def write_reports(star: Star, target_dir: str, names: list[str] | None = None) -> dict[str, str]:
    """Write each report (all by default) as a Parquet folder under ``target_dir``; returns name -> path."""
    out = {}
    for name in names or list(REPORTS):
        path = f"{target_dir.rstrip('/')}/{name}"
        write_table(REPORTS[name](star), path=path, mode="overwrite")
        out[name] = path
    return out
