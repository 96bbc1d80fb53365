"""Append newly prepared rows to a written star: dimensions keep their keys and grow at the end, the fact gets new rows.

Only new dimension rows and new fact rows are written.  Run it once per load: which files are new is the manifest's
question (``sources.manifest``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import calendar as cal
from starmart.operators.joins import lookup_known_keys
from starmart.operators.keys import extend_keys
from starmart.plans.star import DIMENSIONS, LOCATION_ORDER, Star, materialize, star_from_tables
from starmart.schemas import FACT_EXTRA_SQL, FACT_MEASURES, LOCATION_KEY, OFFENCE_KEY, OFFENDER_KEY, TIME_KEY
from starmart.sources.sinks import append_table

KEYS = {"dim_tempo": TIME_KEY, "dim_localizacao": LOCATION_KEY, "dim_infracao": OFFENCE_KEY, "dim_infrator": OFFENDER_KEY}
OFFENCE_ATTRS = {"descricao_infracao": "descricao_abreviada_infracao", "enquadramento_infracao": "enquadramento_infracao"}


def append_to_star(spark: SparkSession, paths: dict[str, str], prepared: DataFrame, rules: str = "sql", holidays: str = "listed") -> Star:
    """Add ``prepared`` rows to the star written under ``paths`` (as ``write_star`` returns them) and open it again.

    New natural keys are numbered on from each dimension's last key; keys that were given stay, and so do the
    attributes of known offence codes.  Under the frame rules NULL keys match.
    """
    prepared = materialize(prepared, "appended_rows")  # four dimensions and the fact read it
    old, first, null_safe = star_from_tables(spark, paths, rules), 1 if rules == "sql" else 0, rules == "frame"
    for name, sk in DIMENSIONS.items():
        order = LOCATION_ORDER if name == "dim_localizacao" else None
        attrs = OFFENCE_ATTRS if name == "dim_infracao" else None
        rows = prepared.filter(F.col("data_infracao").isNotNull()) if name == "dim_tempo" else prepared
        new = extend_keys(old.table(name), rows, KEYS[name], sk, order, attrs, first)
        if not new.rows:
            continue
        df = new.df
        if name == "dim_tempo":
            parts = cal.date_parts("data_infracao")
            df = df.select("*", *[v.alias(k) for k, v in parts.items()], cal.is_holiday("data_infracao", holidays).alias("is_feriado"))
        append_table(df.select(*old.table(name).columns), path=paths[name])
    grown = star_from_tables(spark, paths, rules)
    fact = lookup_known_keys(prepared, [(grown.table(n), KEYS[n], sk, grown.rows[n], grown.sizes[n]) for n, sk in DIMENSIONS.items()], null_safe)
    extra = FACT_EXTRA_SQL if rules == "sql" else []
    append_table(fact.select(*DIMENSIONS.values(), *FACT_MEASURES, *extra).select(*old.fato_multa.columns), path=paths["fato_multa"])
    return star_from_tables(spark, paths, rules)
