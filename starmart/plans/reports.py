"""Reports over the star (Q1-Q9 with their chart-ready variants).

Every report is fact -> dimension joins -> grouped aggregate -> metric.  The
join order is chosen from the checked dimension sizes (``star_rollup``):
broadcastable dimensions are joined first, inside the fact scan's codegen
stage with a map-side partial aggregate after them; for a dimension too
large to broadcast the fact is first pre-aggregated on that dimension's key
(map-side combine collapses hot keys), so only one row per key and group
crosses the shuffle join.  Means and percentages are computed from exact
integer sums and rounded half away from zero (``functions.rounding``).
Reports come in their published order, made total by the group keys (``ORDERS``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import vocab as V
from starmart.functions.decode import region
from starmart.functions.labels import code_label, colour, millions, pair_label
from starmart.functions.rounding import EXACT_BELOW, mean_of_units, to_units, to_units_or_null
from starmart.operators.metrics import change_vs_previous, pivot_change, rank_by, share_of_total, stack_base, top_k
from starmart.plans.star import DIMENSIONS, Star, materialize



@dataclass
class Measure:
    """An aggregate that can be split into a partial and a merge step."""

    out: str
    kind: str  # count | sum | max | min
    expr: Column | None = None  # None with kind='count' counts rows


def _partial(m: Measure) -> Column:
    if m.kind == "count":
        return (F.count(m.expr) if m.expr is not None else F.count(F.lit(1))).alias(m.out)
    return getattr(F, m.kind)(m.expr).alias(m.out)


def _merge(m: Measure) -> Column:
    fn = "sum" if m.kind in ("count", "sum") else m.kind
    return getattr(F, fn)(F.col(m.out)).alias(m.out)


def star_rollup(
    star: Star,
    dims: dict[str, list[str]],
    measures: list[Measure],
    fact_filter: Column | None = None,
    dim_filters: dict[str, Column] | None = None,
    exists: list[str] | None = None,
) -> DataFrame:
    """Group the fact by dimension attributes.

    ``dims``: {dimension: attributes to group by}; ``dim_filters``: predicates
    on a dimension (inner-join semantics); ``exists``: dimensions used only as
    an existence test (left-semi join).
    """
    dim_filters = dim_filters or {}
    f = star.facts()
    if fact_filter is not None:
        f = f.filter(fact_filter)
    for name in exists or []:
        f = f.join(star.dim(name), DIMENSIONS[name], "left_semi")

    def dim_df(name: str) -> DataFrame:
        d = star.table(name)
        if name in dim_filters:
            d = d.filter(dim_filters[name])
        d = d.select(DIMENSIONS[name], *dims[name])
        # the size check is on the unfiltered dimension, an upper bound of the filtered one
        return F.broadcast(d) if star.small(name) else d

    small = [n for n in dims if star.small(n)]
    large = [n for n in dims if n not in small]
    for name in small:
        # degenerate fact attributes with a dimension attribute's name yield to the dimension
        f = f.drop(*[a for a in dims[name] if a in f.columns]).join(dim_df(name), DIMENSIONS[name], "inner")
    group_small = [a for n in small for a in dims[n]]
    if not large:
        return f.groupBy(*group_small).agg(*[_partial(m) for m in measures])
    keys = group_small + [DIMENSIONS[n] for n in large]
    f = f.drop(*[a for n in large for a in dims[n] if a in f.columns and a not in group_small])
    pre = f.groupBy(*keys).agg(*[_partial(m) for m in measures])
    for name in large:
        pre = pre.join(dim_df(name), DIMENSIONS[name], "inner")
    groups = group_small + [a for n in large for a in dims[n]]
    return pre.groupBy(*groups).agg(*[_merge(m) for m in measures])


def _digits(star: Star, col: str = "excesso_verificado") -> int:
    """Exact digits of a fact measure: a DECIMAL's scale; a DOUBLE is taken to 6 decimals."""
    dt = star.fato_multa.schema[col].dataType
    return dt.scale if isinstance(dt, T.DecimalType) else 6


def _mean_measures(star: Star, col: str, prefix: str, nonzero: bool = False) -> list[Measure]:
    x = F.col(col)
    if nonzero:
        x = F.when(x != 0, x)
    exact = isinstance(star.fato_multa.schema[col].dataType, T.DecimalType)
    units = to_units(x, _digits(star, col)) if exact else to_units_or_null(x, _digits(star, col))
    out = [Measure(f"{prefix}_sum", "sum", units), Measure(f"{prefix}_n", "count", x)]
    return out if exact else [*out, Measure(f"{prefix}_top", "max", F.abs(x))]


def _mean(star: Star, prefix: str, col: str = "excesso_verificado") -> Column:
    """Exact mean; NULL for a DOUBLE group that holds a value too large for exact units (``EXACT_BELOW``)."""
    mean = mean_of_units(F.col(f"{prefix}_sum"), F.col(f"{prefix}_n"), _digits(star, col))
    if isinstance(star.fato_multa.schema[col].dataType, T.DecimalType):
        return mean
    return F.when(F.col(f"{prefix}_top") < F.lit(EXACT_BELOW), mean)


def _as_measure(star: Star, name: str, col: str = "excesso_verificado") -> Column:
    """A max/min result in the fact measure's own type (DECIMAL(10,2) or DOUBLE)."""
    return F.col(name).cast(star.fato_multa.schema[col].dataType).alias(name)


# ---------------------------------------------------------------------------
# Q1 — yearly volume per state, region label, % change vs previous year
# ---------------------------------------------------------------------------
def q1_rows(star: Star) -> DataFrame:
    g = star_rollup(
        star,
        {"dim_tempo": ["ano"], "dim_localizacao": ["uf_infracao"]},
        [Measure("total_autos", "count"), Measure("total_infracoes", "sum", F.col("qtd_infracoes").cast("long"))],
        dim_filters={"dim_localizacao": ~F.col("uf_infracao").isin(V.REPORT_EXCLUDED_STATES)},
    )
    g = change_vs_previous(g, ["uf_infracao"], ["ano"], "total_infracoes", "variacao_pct_ano_anterior", kind="pct")
    return g.select(
        "ano",
        region("uf_infracao", V.NOT_IDENTIFIED).alias("regiao"),
        "uf_infracao",
        F.col("total_autos").cast("long").alias("total_autos"),
        F.col("total_infracoes").cast("long").alias("total_infracoes"),
        "variacao_pct_ano_anterior",
    )


def q1(star: Star) -> DataFrame:
    return q1_rows(star).orderBy(*q1_order())


def q1_order() -> list[Column]:
    return [F.col("regiao"), F.col("ano"), F.col("uf_infracao")]


def q1_table(star: Star) -> DataFrame:
    """Q1's rows, written once: what takes the years from them and then their values need not compute them twice."""
    return materialize(q1_rows(star), "q1_rows")


def years_of(rows: DataFrame) -> list[int]:
    """The years that Q1 has rows for (a handful of values)."""
    return sorted(r["ano"] for r in rows.select("ano").distinct().collect())


def q1b(star: Star, rows: DataFrame | None = None) -> DataFrame:
    """Region x year totals, one column per year present, with the first->last year % change (1 decimal), last year's largest first.

    ``rows``: Q1's rows where they are at hand already.
    """
    rows = q1_table(star) if rows is None else rows
    years = years_of(rows)
    if not years:
        return rows.select("regiao").distinct()
    wide = pivot_change(rows, "regiao", "ano", years, "total_infracoes", years[0], years[-1], out="var_pct", scale=1)
    wide = wide.withColumnRenamed("var_pct", f"var_{str(years[0])[-2:]}_{str(years[-1])[-2:]}_pct")
    return wide.orderBy(F.col(str(years[-1])).desc_nulls_last(), "regiao")


def q1c(star: Star) -> DataFrame:
    """Stacked composition: per year and region, the total in millions and the base of its bar segment."""
    by_region = q1_rows(star).groupBy("ano", "regiao").agg(F.sum("total_infracoes").alias("total_infracoes"))
    s = stack_base(by_region, ["ano"], "regiao", V.STACK_ORDER, "total_infracoes", out="base")
    return s.select("ano", "regiao", millions("total_infracoes").alias("total_infracoes_m"), millions("base").alias("base_m"))


# ---------------------------------------------------------------------------
# Q2 — mean / max excess speed by vehicle profile
# ---------------------------------------------------------------------------
def q2(star: Star) -> DataFrame:
    return q2_rows(star).orderBy(*q2_order())


def q2_rows(star: Star) -> DataFrame:
    lo, hi = V.EXCESS_RANGE
    ex = F.col("excesso_verificado")
    g = star_rollup(
        star,
        {"dim_infrator": ["descricao_especie_veiculo", "descricao_tipo_veiculo", "indicador_veiculo_estrangeiro"]},
        [Measure("total_infracoes", "count"), *_mean_measures(star, "excesso_verificado", "ex"), Measure("maior_excesso_kmh", "max", ex)],
        fact_filter=(ex > lo) & (ex <= hi),
        dim_filters={
            "dim_infrator": ~F.col("descricao_especie_veiculo").isin(V.REPORT_EXCLUDED_LABELS)
            & ~F.col("descricao_tipo_veiculo").isin(V.REPORT_EXCLUDED_LABELS)
        },
    )
    return g.filter(F.col("total_infracoes") >= V.MIN_GROUP_ROWS).select(
        F.col("descricao_especie_veiculo").alias("especie_veiculo"),
        F.col("descricao_tipo_veiculo").alias("tipo_veiculo"),
        F.col("indicador_veiculo_estrangeiro").alias("estrangeiro"),
        F.col("total_infracoes").cast("long").alias("total_infracoes"),
        _mean(star, "ex").alias("media_excesso_kmh"),
        _as_measure(star, "maior_excesso_kmh"),
    )


def q2_order() -> list[Column]:
    return [F.col("media_excesso_kmh").desc_nulls_last(), F.col("especie_veiculo"), F.col("tipo_veiculo"), F.col("estrangeiro")]


def q2b(star: Star, k: int = 15) -> DataFrame:
    """Top ``k`` profiles by mean excess with a chart label and a colour by foreign flag."""
    top = top_k(q2_rows(star), q2_order(), k)
    return top.withColumn("label", pair_label("especie_veiculo", "tipo_veiculo")).withColumn(
        "cor", colour("estrangeiro", V.FOREIGN_COLOURS)
    )


# ---------------------------------------------------------------------------
# Q3 — outliers
# ---------------------------------------------------------------------------
def q3(star: Star, threshold: int = V.OUTLIER_EXCESS, k: int = 20) -> DataFrame:
    """The ``k`` largest excesses with their vehicle; only the rows that can be among them are joined."""
    by_vehicle = star.facts().filter(F.col("excesso_verificado") > threshold).groupBy("id_infrator_sk", F.col("excesso_verificado").alias("excesso_kmh"))
    g = by_vehicle.agg(F.count(F.lit(1)).alias("n"))
    # the k largest distinct values (k rows at most); the smallest one needed still has fewer than k rows above it
    levels = g.groupBy("excesso_kmh").agg(F.sum("n").alias("n")).orderBy(F.col("excesso_kmh").desc()).limit(k)
    above = F.sum("n").over(Window.orderBy(F.col("excesso_kmh").desc()).rowsBetween(Window.unboundedPreceding, -1))
    cut = levels.withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < k).select(F.min("excesso_kmh")).scalar()
    vehicles = star.dim("dim_infrator", "descricao_especie_veiculo", "descricao_tipo_veiculo")
    rows = g.filter(F.col("excesso_kmh") >= cut).join(vehicles, "id_infrator_sk")
    rows = rows.select("descricao_especie_veiculo", "descricao_tipo_veiculo", "excesso_kmh", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    return top_k(rows.drop("col"), [F.col("excesso_kmh").desc(), "descricao_especie_veiculo", "descricao_tipo_veiculo"], k)


# ---------------------------------------------------------------------------
# Q4 — top offences with mean non-zero excess
# ---------------------------------------------------------------------------
def q4_all(star: Star) -> DataFrame:
    g = star_rollup(
        star,
        {"dim_infracao": ["codigo_infracao", "descricao_infracao"]},
        [
            Measure("total_autuacoes", "count"),
            *_mean_measures(star, "excesso_verificado", "nz", nonzero=True),
            Measure("maior_excesso_kmh", "max", F.col("excesso_verificado")),
        ],
    )
    return g.select(
        "codigo_infracao",
        "descricao_infracao",
        F.col("total_autuacoes").cast("long").alias("total_autuacoes"),
        _mean(star, "nz").alias("media_excesso_kmh"),
        _as_measure(star, "maior_excesso_kmh"),
    )


def q4_order() -> list[Column]:
    return [F.col("total_autuacoes").desc(), F.col("codigo_infracao"), F.col("descricao_infracao")]


def q4(star: Star, k: int = 20) -> DataFrame:
    return top_k(q4_all(star), q4_order(), k)


def q4b(star: Star, k: int = 10) -> DataFrame:
    """The first ``k`` of Q4 with the '[code] text...' chart label."""
    return top_k(q4_all(star), q4_order(), k).select(
        "codigo_infracao", code_label("codigo_infracao", "descricao_infracao").alias("label"), "total_autuacoes"
    )


# ---------------------------------------------------------------------------
# Q5 — holidays vs weekdays
# ---------------------------------------------------------------------------
def q5(star: Star) -> DataFrame:
    g = star_rollup(
        star,
        {"dim_tempo": ["is_feriado", "dia_semana"]},
        [Measure("total_multas", "count", F.col("numero_auto")), *_mean_measures(star, "excesso_verificado", "ex")],
        exists=["dim_infracao"],
    )
    return g.select(
        "is_feriado",
        "dia_semana",
        F.col("total_multas").cast("long").alias("total_multas"),
        _mean(star, "ex").alias("media_excesso_velocidade_kmh"),
    ).orderBy(*q5_order())


def q5_order() -> list[Column]:
    return [F.col("is_feriado").desc(), F.col("total_multas").desc(), F.col("dia_semana")]


# ---------------------------------------------------------------------------
# Q6 — state x year x quarter with change vs previous quarter
# ---------------------------------------------------------------------------
def q6(star: Star, year: int | None = None) -> DataFrame:
    """``year`` reads that year's fact partition only (its first quarter then has no previous one)."""
    g = star_rollup(
        star,
        {"dim_localizacao": ["uf_infracao"], "dim_tempo": ["ano", "trimestre"]},
        [Measure("total_multas", "count", F.col("numero_auto"))],
        fact_filter=None if year is None else star.in_year(year),
        dim_filters=None if year is None else {"dim_tempo": F.col("ano") == year},
    )
    g = g.withColumn("total_multas", F.col("total_multas").cast("long"))
    g = change_vs_previous(g, ["uf_infracao"], ["ano", "trimestre"], "total_multas", "variacao_trimestre_anterior", kind="abs")
    return g.select("uf_infracao", "ano", "trimestre", "total_multas", "variacao_trimestre_anterior").orderBy(*q6_order())


def q6_order() -> list[Column]:
    return [F.col("ano").desc(), F.col("trimestre").desc(), F.col("total_multas").desc(), F.col("uf_infracao")]


# ---------------------------------------------------------------------------
# Q7 — vehicle profile with share of total
# ---------------------------------------------------------------------------
Q7_COLUMNS = ["descricao_especie_veiculo", "descricao_tipo_veiculo", "indicador_abordagem", "indicador_veiculo_estrangeiro"]


def q7(star: Star) -> DataFrame:
    g = star_rollup(star, {"dim_infrator": Q7_COLUMNS}, [Measure("total_multas", "count", F.col("numero_auto"))])
    g = g.withColumn("total_multas", F.col("total_multas").cast("long"))
    return share_of_total(g, "total_multas").select(*Q7_COLUMNS, "total_multas", "pct_do_total").orderBy(*q7_order())


def q7_order() -> list[Column]:
    return [F.col("total_multas").desc(), *[F.col(c) for c in Q7_COLUMNS]]


# ---------------------------------------------------------------------------
# Q8 — top offences with share of total (share taken before the limit)
# ---------------------------------------------------------------------------
def q8(star: Star, k: int = 10) -> DataFrame:
    cols = ["codigo_infracao", "descricao_infracao", "enquadramento_infracao"]
    g = star_rollup(star, {"dim_infracao": cols}, [Measure("total_multas", "count", F.col("numero_auto"))])
    g = share_of_total(g.withColumn("total_multas", F.col("total_multas").cast("long")), "total_multas")
    return top_k(g, [F.col("total_multas").desc(), "codigo_infracao"], k).select(*cols, "total_multas", "pct_do_total")


# ---------------------------------------------------------------------------
# Q9 — top make/model ranking
# ---------------------------------------------------------------------------
def q9(star: Star, k: int = 10) -> DataFrame:
    mk = F.col("descricao_marca_veiculo")
    g = star_rollup(
        star,
        {"dim_infrator": ["descricao_marca_veiculo", "descricao_modelo_veiculo"]},
        [Measure("total_multas", "count", F.col("numero_auto"))],
        dim_filters={"dim_infrator": mk.isNotNull() & (mk != V.NOT_INFORMED)},
    )
    g = g.withColumn("total_multas", F.col("total_multas").cast("long"))
    order = [F.col("total_multas").desc(), F.col("descricao_marca_veiculo"), F.col("descricao_modelo_veiculo")]
    return rank_by(g, order, k).select("ranking", "descricao_marca_veiculo", "descricao_modelo_veiculo", "total_multas")


REPORTS = {
    "report_q1": q1,
    "report_q1b": q1b,
    "report_q1c": q1c,
    "report_q2": q2,
    "report_q2b": q2b,
    "report_q3": q3,
    "report_q4": q4,
    "report_q4b": q4b,
    "report_q5": q5,
    "report_q6": q6,
    "report_q7": q7,
    "report_q8": q8,
    "report_q9": q9,
}

#: Published order of the reports that are not limits or rankings already.
ORDERS = {
    "report_q1": q1_order,
    "report_q2": q2_order,
    "report_q5": q5_order,
    "report_q6": q6_order,
    "report_q7": q7_order,
}
