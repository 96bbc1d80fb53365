"""Data-quality checks (T1-T4), shaped like generic warehouse schema tests.

Each check returns the failing rows as a DataFrame (empty = pass):

* ``check_not_null``   -> rows whose column is NULL
* ``check_unique``     -> (value, n_records) for non-NULL values seen more than once
* ``check_accepted``   -> (value, n_records) for non-NULL values outside the list
* ``check_references`` -> child rows whose non-NULL key has no parent

``run_checks`` runs a list of checks and returns one row per check with its
failure count; counts are distributed aggregates, nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.joins import anti_join


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_references(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return anti_join(df, parent, column, parent_column)


@dataclass
class Check:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values | relationships
    values: list | None = None
    parent: str | None = None
    parent_column: str | None = None


def failures(tables: dict[str, DataFrame], c: Check) -> DataFrame:
    df = tables[c.model]
    if c.test == "not_null":
        bad = check_not_null(df, c.column)
    elif c.test == "unique":
        bad = check_unique(df, c.column).select(F.col("n_records"))
    elif c.test == "accepted_values":
        bad = check_accepted(df, c.column, c.values or []).select(F.col("n_records"))
    elif c.test == "relationships":
        bad = check_references(df, c.column, tables[c.parent], c.parent_column or c.column)
    else:
        raise ValueError(c.test)
    if c.test in ("unique", "accepted_values"):
        n = F.coalesce(F.sum("n_records"), F.lit(0)).cast("long")
    else:
        n = F.count(F.lit(1)).cast("long")
    return bad.agg(n.alias("failures")).select(
        F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"), "failures"
    )


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: (model, column_name, test, failures).

    Row-wise checks (not_null, accepted_values) of one table share a single
    aggregate pass; unique checks are one grouped aggregate each and
    relationship checks one anti join each.
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    unique_by_model: dict[str, list[Check]] = {}
    refs_by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.test in ("not_null", "accepted_values"):
            by_model.setdefault(c.model, []).append(c)
        elif c.test == "unique":
            unique_by_model.setdefault(c.model, []).append(c)
        elif c.test == "relationships":
            refs_by_model.setdefault(c.model, []).append(c)
        else:
            parts.append(failures(tables, c))
    for model, cs in unique_by_model.items():
        parts.append(_unique_batch(tables[model], cs))
    for model, cs in refs_by_model.items():
        parts.append(_references_batch(tables, cs))
    for model, cs in by_model.items():
        aggs = []
        for i, c in enumerate(cs):
            col = F.col(c.column)
            bad = col.isNull() if c.test == "not_null" else (col.isNotNull() & ~col.isin(c.values or []))
            aggs.append(F.count_if(bad).cast("long").alias(f"f{i}"))
        one = tables[model].agg(*aggs)
        rows = F.array(*[
            F.struct(F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"),
                     F.col(f"f{i}").alias("failures"))
            for i, c in enumerate(cs)
        ])
        parts.append(one.select(F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stack_type(dfs_cols: list[tuple[DataFrame, str]]):
    """The common type of the stacked columns, or STRING when they differ."""
    types = {df.schema[c].dataType for df, c in dfs_cols}
    return types.pop() if len(types) == 1 else T.StringType()


def _unique_batch(df: DataFrame, cs: list[Check]) -> DataFrame:
    """All unique checks of one table in one scan: (column, value) pairs counted by one grouped aggregate."""
    st = _stack_type([(df, c.column) for c in cs])
    pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c.column).cast(st).alias("__v")) for i, c in enumerate(cs)]))
    counts = df.select(pairs).filter(F.col("__v").isNotNull()).groupBy("__c", "__v").agg(F.count(F.lit(1)).alias("__n"))
    dup = counts.filter(F.col("__n") > 1).groupBy("__c").agg(F.sum("__n").cast("long").alias("failures"))
    names = F.create_map(*[x for i, c in enumerate(cs) for x in (F.lit(i), F.lit(c.column))])
    every = df.sparkSession.createDataFrame([(i,) for i in range(len(cs))], "__c int")  # one row per check
    return every.join(F.broadcast(dup), "__c", "left").select(
        F.lit(cs[0].model).alias("model"),
        F.element_at(names, F.col("__c")).alias("column_name"),
        F.lit("unique").alias("test"),
        F.coalesce(F.col("failures"), F.lit(0).cast("long")).alias("failures"),
    )


def _references_batch(tables: dict[str, DataFrame], cs: list[Check]) -> DataFrame:
    """All relationship checks of one child table in one scan.

    Child keys are stacked as (check, key) and pre-aggregated to distinct
    pairs with their row counts (a hot key collapses map-side), then one
    anti join against the stacked parent keys leaves the orphans.
    """
    child = tables[cs[0].model]
    st = _stack_type([(child, c.column) for c in cs] + [(tables[c.parent], c.parent_column or c.column) for c in cs])
    pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c.column).cast(st).alias("__k")) for i, c in enumerate(cs)]))
    keys = child.select(pairs).filter(F.col("__k").isNotNull()).groupBy("__c", "__k").agg(F.count(F.lit(1)).alias("__n"))
    parent = None
    for i, c in enumerate(cs):
        p = tables[c.parent].select(F.lit(i).alias("__c"), F.col(c.parent_column or c.column).cast(st).alias("__k"))
        parent = p if parent is None else parent.unionByName(p)
    orphans = keys.join(parent.distinct(), ["__c", "__k"], "left_anti").groupBy("__c").agg(F.sum("__n").cast("long").alias("failures"))
    names = F.create_map(*[x for i, c in enumerate(cs) for x in (F.lit(i), F.lit(c.column))])
    every = child.sparkSession.createDataFrame([(i,) for i in range(len(cs))], "__c int")
    return every.join(F.broadcast(orphans), "__c", "left").select(
        F.lit(cs[0].model).alias("model"),
        F.element_at(names, F.col("__c")).alias("column_name"),
        F.lit("relationships").alias("test"),
        F.coalesce(F.col("failures"), F.lit(0).cast("long")).alias("failures"),
    )


# The warehouse's declared tests, with column names as the models define them.
# The declared tests of the star.
STAR_CHECKS: list[Check] = [
    Check("prepared", "numero_auto", "not_null"),
    Check("prepared", "numero_auto", "unique"),
    Check("fato_multa", "numero_auto", "not_null"),
    Check("fato_multa", "numero_auto", "unique"),
    Check("fato_multa", "id_tempo_sk", "not_null"),
    Check("fato_multa", "id_tempo_sk", "relationships", parent="dim_tempo"),
    Check("fato_multa", "id_localizacao_sk", "not_null"),
    Check("fato_multa", "id_localizacao_sk", "relationships", parent="dim_localizacao"),
    Check("fato_multa", "id_infracao_sk", "not_null"),
    Check("fato_multa", "id_infracao_sk", "relationships", parent="dim_infracao"),
    Check("fato_multa", "id_infrator_sk", "not_null"),
    Check("fato_multa", "id_infrator_sk", "relationships", parent="dim_infrator"),
    Check("dim_infracao", "id_infracao_sk", "not_null"),
    Check("dim_infracao", "id_infracao_sk", "unique"),
    Check("dim_infracao", "codigo_infracao", "not_null"),
    Check("dim_infracao", "codigo_infracao", "unique"),
    Check("dim_infracao", "descricao_infracao", "not_null"),
    Check("dim_localizacao", "id_localizacao_sk", "not_null"),
    Check("dim_localizacao", "id_localizacao_sk", "unique"),
    Check("dim_localizacao", "municipio", "not_null"),
    Check("dim_localizacao", "uf_infracao", "not_null"),
    Check("dim_tempo", "id_tempo_sk", "not_null"),
    Check("dim_tempo", "id_tempo_sk", "unique"),
    Check("dim_tempo", "data_infracao", "not_null"),
    Check("dim_tempo", "data_infracao", "unique"),
    Check("dim_tempo", "ano", "not_null"),
    Check("dim_tempo", "mes", "not_null"),
    Check("dim_tempo", "trimestre", "not_null"),
    Check("dim_tempo", "dia_semana", "not_null"),
    Check("dim_tempo", "is_feriado", "not_null"),
    Check("dim_infrator", "id_infrator_sk", "not_null"),
    Check("dim_infrator", "id_infrator_sk", "unique"),
    Check("dim_infrator", "descricao_especie_veiculo", "not_null"),
    Check("dim_infrator", "descricao_tipo_veiculo", "not_null"),
    Check("dim_infrator", "indicador_veiculo_estrangeiro", "accepted_values", values=["S", "N", "N/I"]),
]
