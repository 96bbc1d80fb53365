"""Command line: ``python -m starmart <input-glob> <target-dir> [--rules sql|frame]``.

Loads the files into a star under ``<target-dir>/star`` and writes every
report under ``<target-dir>/reports``.  Uses the active session settings of
``spark-submit``; run locally it starts a local session.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starmart.plans.warehouse import load_warehouse, write_reports
from starmart.session import RECOMMENDED_CONF, ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="starmart")
    ap.add_argument("inputs", help="a folder (every *.csv below it) or a glob, e.g. '/data/fines/*/*.csv'")
    ap.add_argument("target", help="output folder")
    ap.add_argument("--rules", choices=["sql", "frame"], default="sql")
    ap.add_argument("--holidays", choices=["listed", "computed"], default="listed")
    ap.add_argument("--sep", default=";")
    ap.add_argument("--multiline", action="store_true", help="quoted fields may contain line breaks")
    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName("starmart")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    folder = not any(ch in args.inputs for ch in "*?[")  # a folder: every *.csv below it
    star = load_warehouse(spark, args.inputs, f"{args.target}/star", args.rules, args.holidays, args.sep, args.multiline, folder)
    write_reports(star, f"{args.target}/reports")


if __name__ == "__main__":
    main()
