"""Registry of runnable queries: name -> callable(spark, sf_dir) -> DataFrame.

The star is built once per (session, input folder, rule set) and its tables
are written to the shared checkpoint folder; reports read those tables, as
reports read the materialised warehouse tables.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.quality import STAR_CHECKS, run_checks
from starmart.plans import generic as G
from starmart.plans import reports as R
from starmart.plans import upkeep as U
from starmart.plans.prepare import normalize
from starmart.plans.star import Star, build_star
from starmart.sources.tables import forget_landing, landing

_STARS: dict[tuple, Star] = {}
_LOCK = threading.Lock()


def star_for(spark: SparkSession, sf_dir: str, rules: str = "sql", timings: dict | None = None, view: str = "fines_raw") -> Star:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), rules, view)
    with _LOCK:  # queries submitted from several threads build a star once
        if key not in _STARS:
            _STARS[key] = build_star(normalize(landing(spark, sf_dir, view), rules), rules, timings=timings)
        return _STARS[key]


def forget(spark: SparkSession) -> None:
    """Drop this session's stars and landing tables, with the folders they were written to."""
    with _LOCK:
        for key in [k for k in _STARS if k[0] == spark.sparkContext.applicationId]:
            _STARS.pop(key).drop()
    forget_landing(spark)


def _star_table(name: str, rules: str = "sql") -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: star_for(spark, sf, rules).table(name)


def _report(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(star_for(spark, sf, "sql"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["prepared_sql"] = lambda spark, sf: normalize(landing(spark, sf), "sql")
    q["prepared_frame"] = lambda spark, sf: normalize(landing(spark, sf), "frame")
    q["dim_time"] = _star_table("dim_tempo")
    q["dim_location"] = _star_table("dim_localizacao")
    q["dim_offence"] = _star_table("dim_infracao")
    q["dim_offender"] = _star_table("dim_infrator")
    q["fact_sql"] = _star_table("fato_multa")
    for name, fn in R.REPORTS.items():
        q[name] = _report(fn)
    # the notebook analyses read the star loaded by the data-frame pipeline
    for name in ("report_q1", "report_q1b", "report_q1c", "report_q2", "report_q2b", "report_q4", "report_q4b"):
        q[f"{name}_frame"] = (lambda fn: lambda spark, sf: fn(star_for(spark, sf, "frame")))(R.REPORTS[name])
    q["dim_location_frame"] = _star_table("dim_localizacao", "frame")
    q["dim_offender_frame"] = _star_table("dim_infrator", "frame")
    q["fact_null_safe"] = _star_table("fato_multa", "frame")
    q["test_suite"] = lambda spark, sf: _suite(star_for(spark, sf, "sql"), spark, sf)
    q["labels_and_formats"] = lambda spark, sf: _labels(star_for(spark, sf, "sql"))
    # the published order of a report as a column, so that comparing rows also compares the order
    for name, order in R.ORDERS.items():
        q[f"{name}_ordered"] = (lambda fn, order: lambda spark, sf: G.ordered(fn(star_for(spark, sf, "sql")), order()))(R.REPORTS[name], order)
    q["report_q1b_ordered"] = lambda spark, sf: _q1b_ordered(star_for(spark, sf, "sql"))
    q["profile_nulls_ordered"] = lambda spark, sf: G.ordered(G.profile_nulls(spark, sf), [F.col("pct").desc(), "column_name"])
    q["top_parts_ordered"] = lambda spark, sf: G.ordered(G.top_parts(spark, sf), G.top_parts_order())
    q["report_q6_one_year"] = lambda spark, sf: R.q6(star_for(spark, sf, "sql"), 2023)
    q["sql_over_views"] = lambda spark, sf: G.sql_over_views(star_for(spark, sf, "sql"))
    # the same records over seven years, with numbers outside the usual ranges
    q["prepared_frame_wide"] = lambda spark, sf: normalize(landing(spark, sf, "fines_wide"), "frame")
    q["report_q1b_wide"] = lambda spark, sf: R.q1b(star_for(spark, sf, "sql", view="fines_wide"))
    q["labels_and_formats_wide"] = lambda spark, sf: _labels(star_for(spark, sf, "sql", view="fines_wide"))
    q["report_q4_frame_wide"] = lambda spark, sf: R.q4(star_for(spark, sf, "frame", view="fines_wide"))
    q["holiday_flag"] = lambda spark, sf: G.holiday_flag(star_for(spark, sf, "sql").dim_tempo)
    # data tests run on the materialised PREPARED table, as warehouse tests run on the model table
    q["test_unique"] = lambda spark, sf: G.test_unique(star_for(spark, sf, "sql").prepared)
    q["test_accepted"] = lambda spark, sf: G.test_accepted(star_for(spark, sf, "sql").prepared)
    q.update(G.GENERIC)
    # the two rule sets against each other
    for name, fn in (("reconcile_rules", U.reconcile_rules), ("reconcile_columns", U.reconcile_columns), ("reconcile_classes", U.reconcile_classes)):
        q[name] = (lambda fn: lambda spark, sf: fn(star_for(spark, sf, "sql").prepared, star_for(spark, sf, "frame").prepared))(fn)
    q["report_bucketed"] = lambda spark, sf: U.report_bucketed(spark, sf, star_for(spark, sf, "sql"))
    q.update(U.FLOWS)
    return q


def _labels(star: Star) -> DataFrame:
    rows = R.q1_table(star)
    return G.labels_and_formats(rows, R.years_of(rows))


def _q1b_ordered(star: Star) -> DataFrame:
    rows = R.q1_table(star)
    years = R.years_of(rows)
    return G.ordered(R.q1b(star, rows), [F.col(str(years[-1])).desc_nulls_last(), "regiao"])


def _suite(star: Star, spark: SparkSession, sf: str) -> DataFrame:
    tables = {n: star.table(n) for n in ("dim_tempo", "dim_localizacao", "dim_infracao", "dim_infrator", "fato_multa")}
    tables["prepared"] = star.prepared if star.prepared is not None else normalize(landing(spark, sf), "sql")
    return run_checks(tables, STAR_CHECKS)
