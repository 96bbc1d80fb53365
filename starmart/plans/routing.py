"""Clean step with sanity filters: every raw row goes to the clean table or, with all its reasons, to the rejects.

One pass: the cleaning projection and the reasons are computed together, the rows are written once, in two folders by
their destination, and the totals are observed by that same write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmart.functions import vocab as V
from starmart.plans.prepare import SQL, typed
from starmart.schemas import RAW_COLUMNS
from starmart.session import work_dir

# The published cut of the excess report and the range of valid hours.
LIMITS: dict[str, tuple[float, float]] = {"excesso_verificado": (0, 150), "hora_infracao": V.HOUR_RANGE}
NO_NUMBER, NO_DATE = "sem_numero", "data_invalida"


@dataclass
class Routed:
    clean: DataFrame  # the cleaned rows, as ``normalize`` gives them
    rejects: DataFrame  # the 25 raw columns and ``motivos``, an array in the order of ``reasons``
    totals: dict[str, int]  # rows in, clean, rejected, and rows per reason


def reasons(prepared: DataFrame, limits: dict[str, tuple[float, float]], domains: dict[str, list[str]]) -> dict[str, Column]:
    """Condition of each reason on a typed row: a number outside its range, a value outside its list, no key, no date."""
    out = {NO_NUMBER: F.col("numero_auto").isNull(), NO_DATE: F.col("data_infracao").isNull()}
    for c, (low, high) in limits.items():
        v = F.col(c).try_cast("double") if dict(prepared.dtypes)[c] == "string" else F.col(c)
        out[f"{c}_fora_do_limite"] = (v < F.lit(low)) | (v > F.lit(high))
    for c, values in domains.items():
        out[f"{c}_fora_do_dominio"] = F.col(c).isNull() | ~F.col(c).isin(values)
    return {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}


def route(
    raw: DataFrame,
    rules: str = SQL,
    limits: dict[str, tuple[float, float]] | None = None,
    domains: dict[str, list[str]] | None = None,
    holidays: str = "listed",
    path: str | None = None,
) -> Routed:
    """Clean ``raw`` under ``rules`` and set rows aside that fail a check, in one pass over it.

    Besides the rules' own checks (auto number, valid date), ``limits`` gives the range of a cleaned number (a NULL is
    no fault) and ``domains`` the accepted values of a cleaned text.  Clean and rejected rows together are the input
    (its distinct rows under the SQL rules).  Written under ``path`` (default: the shared work folder).
    """
    spark = raw.sparkSession
    rows = typed(raw, rules, holidays, keep_raw=True)
    found = reasons(rows, LIMITS if limits is None else limits, domains or {})
    why = F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in found.items()]), lambda k: k.isNotNull())
    rows = rows.withColumn("motivos", why).withColumn("rejeitada", F.size("motivos") > 0)
    seen = Observation()
    counts = [F.count_if(F.array_contains("motivos", k)).alias(k) for k in found]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("entrada"), F.count_if(~F.col("rejeitada")).alias("limpas"), F.count_if("rejeitada").alias("rejeitadas"), *counts)
    # a clean row needs no raw text any more
    rows = rows.withColumn("raw", F.when(F.col("rejeitada"), F.col("raw")))
    path = path or work_dir(spark, f"routed_{rules}")
    rows.write.partitionBy("rejeitada").parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)
    clean = back.filter(~F.col("rejeitada")).drop("raw", "motivos", "rejeitada")
    rejects = back.filter("rejeitada").select(*[F.col(f"raw.{c}") for c in RAW_COLUMNS], "motivos")
    return Routed(clean, rejects, {k: int(v or 0) for k, v in seen.get.items()})
