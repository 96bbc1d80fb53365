"""Independent SQL (DuckDB dialect) for every registered query.

Used by the correctness gate: the same parquet tables are registered as
views, this SQL runs there, and its result must equal the Spark result
(row count, schema, order-insensitive values).  Fixed value lists are
rendered from ``starmart.functions.vocab`` so both sides use one source of
domain values; the logic is written independently in plain SQL.
"""

from __future__ import annotations

from starmart.functions import vocab as V
from starmart.functions.text import PY_WHITESPACE
from starmart.sources.tables import FINES_RAW_SQL, FINES_WIDE_SQL

NI = V.NOT_INFORMED


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def region_case(col: str, default: str) -> str:
    whens = " ".join(f"WHEN {col} IN {lst(states)} THEN {q(name)}" for name, states in V.REGIONS.items())
    return f"CASE {whens} ELSE {q(default)} END"


def weekday_case(col: str) -> str:
    whens = " ".join(f"WHEN {i + 1} THEN {q(n)}" for i, n in enumerate(V.WEEKDAYS))
    return f"CASE isodow({col}) {whens} END"


def holiday_case(col: str) -> str:
    fixed = " OR ".join(f"(month({col}) = {m} AND day({col}) = {d})" for m, d in V.FIXED_HOLIDAYS)
    listed = ", ".join(f"DATE {q(x)}" for days in V.MOVABLE_HOLIDAYS.values() for x in days)
    return f"({fixed} OR {col} IN ({listed}))"


PYWS = q(PY_WHITESPACE)


def pystrip(col: str) -> str:
    return f"trim({col}, {PYWS})"


FINES_RAW_CTE = f"fines_raw AS ({FINES_RAW_SQL})"

# ---------------------------------------------------------------------------
# PREPARED, SQL rules
# ---------------------------------------------------------------------------
_NUM_INT = "'-?[0-9]+'"
_NUM_DEC = r"'-?[0-9]*\.?[0-9]+'"


def _guarded_int(col: str, default: int) -> str:
    v = f"coalesce({col}, {q(str(default))})"
    return f"CAST(CASE WHEN regexp_full_match({v}, {_NUM_INT}) THEN coalesce(TRY_CAST({v} AS INTEGER), {default}) ELSE {default} END AS INTEGER)"


def _guarded_dec(col: str) -> str:
    v = f"replace(coalesce({col}, '0'), ',', '.')"
    return (
        f"CAST(CASE WHEN regexp_full_match({v}, {_NUM_DEC}) THEN coalesce(TRY_CAST({v} AS DECIMAL(10,2)), 0) "
        f"ELSE 0 END AS DECIMAL(10,2))"
    )


def _species_sql(c: str) -> str:
    u = f"upper(trim({c}))"
    fixes = " ".join(f"WHEN {u} = {q(k)} THEN {q(v)}" for k, v in V.SPECIES_ACCENT_FIX.items())
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN {q(V.NOT_INFORMED_SPECIES_BLANK)} "
        f"WHEN {u} IN {lst(V.MISSING_TERMS_SPECIES_SQL)} THEN {q(NI)} {fixes} ELSE {u} END"
    )


def _terms_sql(c: str, terms) -> str:
    u = f"upper(trim({c}))"
    return f"CASE WHEN {c} IS NULL OR {u} IN {lst(terms)} THEN {q(NI)} ELSE {u} END"


def _doc_sql(c: str) -> str:
    u = f"upper(trim({c}))"
    whens = " ".join(f"WHEN {u} = {q(k)} THEN {q(v)}" for k, v in V.DOC_TYPES.items())
    return f"CASE {whens} WHEN trim({c}) = '' THEN {q(NI)} ELSE coalesce({c}, {q(NI)}) END"


def _dir_sql(c: str, default: str, strip) -> str:
    u = f"upper({strip(c)})"
    whens = " ".join(f"WHEN {u} = {q(k)} THEN {q(v)}" for k, v in V.DIRECTIONS.items())
    return f"CASE {whens} ELSE {q(default)} END"


def _foreign_sql(c: str) -> str:
    return f"CASE WHEN {c} IN {lst(V.FOREIGN_YES)} THEN 'S' WHEN {c} IN {lst(V.FOREIGN_NO)} THEN 'N' ELSE 'N/I' END"


def _plate_sql(c: str) -> str:
    keep = V.STATES + ["N/I", "EX"]
    return (
        f"CASE WHEN {c} IN {lst(keep)} THEN {c} WHEN {c} IN {lst(V.PLATE_JUNK)} THEN 'N/I' "
        f"WHEN length({c}) = 2 AND regexp_matches({c}, '[0-9]') THEN 'EX' ELSE 'N/I' END"
    )


PREPARED_SQL_CTE = f"""
stg AS (SELECT DISTINCT * FROM fines_raw),
typed AS (
  SELECT
    numero_auto,
    coalesce(uf_infracao, {q(NI)}) AS uf_infracao,
    coalesce(municipio, {q(NI)}) AS municipio,
    coalesce(indicador_abordagem, {q(NI)}) AS indicador_abordagem,
    coalesce(br_infracao, {q(NI)}) AS br_infracao,
    {_doc_sql('assinatura_auto')} AS assinatura_auto,
    {_dir_sql('sentido_trafego', NI, lambda c: f'trim({c})')} AS sentido_trafego,
    {_foreign_sql('indicador_veiculo_estrangeiro')} AS indicador_veiculo_estrangeiro,
    {_plate_sql('uf_placa')} AS uf_placa,
    {_species_sql(f"coalesce(descricao_especie_veiculo, {q(NI)})")} AS descricao_especie_veiculo,
    {_terms_sql(f"coalesce(descricao_tipo_veiculo, {q(NI)})", V.MISSING_TERMS)} AS descricao_tipo_veiculo,
    {_terms_sql(f"coalesce(descricao_marca_veiculo, {q(NI)})", V.MISSING_TERMS_MAKE_SQL)} AS descricao_marca_veiculo,
    coalesce(descricao_modelo_veiculo, {q(NI)}) AS descricao_modelo_veiculo,
    coalesce(descricao_abreviada_infracao, {q(NI)}) AS descricao_abreviada_infracao,
    coalesce(enquadramento_infracao, {q(NI)}) AS enquadramento_infracao,
    {_guarded_int('codigo_infracao', 0)} AS codigo_infracao,
    {_guarded_int('km_infracao', 0)} AS km_infracao,
    {_guarded_int('qtd_infracoes', 1)} AS qtd_infracoes,
    CAST(CASE WHEN hora_infracao IS NULL THEN NULL WHEN regexp_full_match(hora_infracao, {_NUM_INT})
              THEN coalesce(TRY_CAST(hora_infracao AS INTEGER), 0) ELSE 0 END AS INTEGER) AS hora_infracao,
    {_guarded_dec('medicao_considerada')} AS medicao_considerada,
    {_guarded_dec('excesso_verificado')} AS excesso_verificado,
    CASE WHEN regexp_full_match(data_infracao, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST(data_infracao AS DATE) END AS data_infracao
  FROM stg
),
prepared AS (
  SELECT *,
    CAST(day(data_infracao) AS INTEGER) AS dia,
    CAST(month(data_infracao) AS INTEGER) AS mes,
    CAST(year(data_infracao) AS INTEGER) AS ano,
    CAST(quarter(data_infracao) AS INTEGER) AS trimestre,
    {weekday_case('data_infracao')} AS dia_semana,
    {region_case('uf_infracao', NI)} AS regiao_infracao
  FROM typed
  WHERE numero_auto IS NOT NULL AND data_infracao IS NOT NULL
)"""

# ---------------------------------------------------------------------------
# PREPARED, frame rules
# ---------------------------------------------------------------------------
_NUMBER = r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?'"


def _numtext(expr: str) -> str:
    s = pystrip(expr)
    return f"CASE WHEN regexp_full_match({s}, {_NUMBER}) THEN TRY_CAST({s} AS DOUBLE) END"


def _frame_int(c: str, default: int) -> str:
    d = _numtext(c)
    return f"CAST(CASE WHEN abs({d}) < 9223372036854775808.0 THEN trunc({d}) ELSE {default} END AS BIGINT)"


def _blank(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN {q(NI)} ELSE {c} END"


def _terms_frame(c: str) -> str:
    u = f"upper({pystrip(c)})"
    return f"CASE WHEN {c} IS NULL OR {u} IN {lst(V.MISSING_TERMS)} THEN {q(NI)} ELSE {u} END"


def _species_frame(c: str) -> str:
    u = f"upper({pystrip(c)})"
    kept = V.SPECIES_KEPT + ["TRAÇÃO", "COLEÇÃO"]
    return (
        f"CASE WHEN {c} IS NULL OR {u} IN {lst(V.MISSING_TERMS)} THEN {q(NI)} "
        f"WHEN {u} = 'TRACAO' THEN 'TRAÇÃO' WHEN {u} = 'COLECAO' THEN 'COLEÇÃO' "
        f"WHEN {u} IN {lst(kept)} THEN {u} ELSE {q(NI)} END"
    )


def _doc_frame(c: str) -> str:
    u = f"upper({pystrip(c)})"
    whens = " ".join(f"WHEN {u} = {q(k)} THEN {q(v)}" for k, v in V.DOC_TYPES.items())
    return f"CASE {whens} WHEN {c} IS NULL OR {u} = '' THEN {q(NI)} ELSE {u} END"


def _plate_frame(c: str) -> str:
    u = f"upper({pystrip(c)})"
    keep = V.STATES + ["N/I", "EX"]
    one = pystrip(f"replace(replace({u}, '''', ''), '-', '')")
    return (
        f"CASE WHEN {u} IN {lst(keep)} THEN {u} WHEN {u} = '/' THEN 'N/I' WHEN {one} = '1' THEN 'N/I' "
        f"WHEN length({u}) = 2 AND regexp_matches({u}, '[0-9]') THEN 'EX' ELSE 'N/I' END"
    )


def _km_frame(c: str) -> str:
    s = pystrip(c)
    return f"coalesce(CASE WHEN regexp_full_match({s}, '[0-9]+([,.][0-9]+)?') THEN TRY_CAST(replace({s}, ',', '.') AS DOUBLE) END, 0.0)"


def _dec_frame(c: str) -> str:
    return f"coalesce({_numtext(f"replace({c}, ',', '.')")}, 0.0)"


PREPARED_FRAME_CTE = f"""
ftyped AS (
  SELECT
    numero_auto,
    {_blank('uf_infracao')} AS uf_infracao,
    {_blank('municipio')} AS municipio,
    indicador_abordagem,
    br_infracao,
    {_doc_frame('assinatura_auto')} AS assinatura_auto,
    {_dir_sql('sentido_trafego', V.NOT_INFORMED_FRAME, pystrip)} AS sentido_trafego,
    {_foreign_sql('indicador_veiculo_estrangeiro')} AS indicador_veiculo_estrangeiro,
    {_plate_frame('uf_placa')} AS uf_placa,
    {_species_frame('descricao_especie_veiculo')} AS descricao_especie_veiculo,
    {_terms_frame('descricao_tipo_veiculo')} AS descricao_tipo_veiculo,
    {_terms_frame('descricao_marca_veiculo')} AS descricao_marca_veiculo,
    {_blank('descricao_modelo_veiculo')} AS descricao_modelo_veiculo,
    {_blank('descricao_abreviada_infracao')} AS descricao_abreviada_infracao,
    {_blank('enquadramento_infracao')} AS enquadramento_infracao,
    {_frame_int('codigo_infracao', 0)} AS codigo_infracao,
    {_km_frame('km_infracao')} AS km_infracao,
    {_frame_int('qtd_infracoes', 1)} AS qtd_infracoes,
    hora_infracao,
    {_dec_frame('medicao_considerada')} AS medicao_considerada,
    {_dec_frame('excesso_verificado')} AS excesso_verificado,
    CASE WHEN regexp_full_match(data_infracao, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST(data_infracao AS DATE) END AS data_infracao,
    {region_case(f'upper({pystrip("uf_infracao")})', V.NOT_INFORMED_FRAME)} AS regiao_infracao
  FROM fines_raw
),
fprepared AS (
  SELECT numero_auto, uf_infracao, municipio, indicador_abordagem, br_infracao, assinatura_auto, sentido_trafego,
    indicador_veiculo_estrangeiro, uf_placa, descricao_especie_veiculo, descricao_tipo_veiculo, descricao_marca_veiculo,
    descricao_modelo_veiculo, descricao_abreviada_infracao, enquadramento_infracao, codigo_infracao, km_infracao,
    qtd_infracoes, hora_infracao, medicao_considerada, excesso_verificado, data_infracao,
    CAST(day(data_infracao) AS INTEGER) AS dia,
    CAST(month(data_infracao) AS INTEGER) AS mes,
    CAST(year(data_infracao) AS INTEGER) AS ano,
    CAST(quarter(data_infracao) AS INTEGER) AS trimestre,
    {weekday_case('data_infracao')} AS dia_semana,
    regiao_infracao,
    {holiday_case('data_infracao')} AS is_feriado
  FROM ftyped
  WHERE numero_auto IS NOT NULL AND data_infracao IS NOT NULL
)"""

# ---------------------------------------------------------------------------
# Star (SQL rules)
# ---------------------------------------------------------------------------
STAR_CTE = f"""
dim_tempo AS (
  SELECT row_number() OVER (ORDER BY data_infracao) AS id_tempo_sk, data_infracao,
    CAST(day(data_infracao) AS INTEGER) AS dia, CAST(month(data_infracao) AS INTEGER) AS mes,
    CAST(year(data_infracao) AS INTEGER) AS ano, CAST(quarter(data_infracao) AS INTEGER) AS trimestre,
    {weekday_case('data_infracao')} AS dia_semana, {holiday_case('data_infracao')} AS is_feriado
  FROM (SELECT DISTINCT data_infracao FROM prepared WHERE data_infracao IS NOT NULL)
),
dim_localizacao AS (
  SELECT row_number() OVER (ORDER BY uf_infracao NULLS LAST, municipio NULLS LAST, br_infracao NULLS LAST,
           km_infracao NULLS LAST, regiao_infracao NULLS LAST, sentido_trafego NULLS LAST) AS id_localizacao_sk,
    uf_infracao, br_infracao, km_infracao, municipio, regiao_infracao, sentido_trafego
  FROM (SELECT DISTINCT uf_infracao, br_infracao, km_infracao, municipio, regiao_infracao, sentido_trafego FROM prepared)
),
dim_infracao AS (
  SELECT row_number() OVER (ORDER BY codigo_infracao NULLS LAST) AS id_infracao_sk, codigo_infracao,
    descricao_infracao, enquadramento_infracao
  FROM (SELECT codigo_infracao, max(descricao_abreviada_infracao) AS descricao_infracao,
          max(enquadramento_infracao) AS enquadramento_infracao FROM prepared GROUP BY codigo_infracao)
),
dim_infrator AS (
  SELECT row_number() OVER (ORDER BY indicador_veiculo_estrangeiro NULLS LAST, uf_placa NULLS LAST,
           descricao_especie_veiculo NULLS LAST, descricao_marca_veiculo NULLS LAST, descricao_tipo_veiculo NULLS LAST,
           descricao_modelo_veiculo NULLS LAST, indicador_abordagem NULLS LAST, assinatura_auto NULLS LAST) AS id_infrator_sk,
    indicador_veiculo_estrangeiro, uf_placa, descricao_especie_veiculo, descricao_marca_veiculo, descricao_tipo_veiculo,
    descricao_modelo_veiculo, indicador_abordagem, assinatura_auto
  FROM (SELECT DISTINCT indicador_veiculo_estrangeiro, uf_placa, descricao_especie_veiculo, descricao_marca_veiculo,
          descricao_tipo_veiculo, descricao_modelo_veiculo, indicador_abordagem, assinatura_auto FROM prepared)
),
fato_multa AS (
  SELECT t.id_tempo_sk, l.id_localizacao_sk, i.id_infracao_sk, v.id_infrator_sk,
    s.numero_auto, s.qtd_infracoes, s.medicao_considerada, s.excesso_verificado,
    s.indicador_abordagem, s.assinatura_auto, s.sentido_trafego
  FROM prepared s
  LEFT JOIN dim_tempo t ON s.data_infracao = t.data_infracao
  LEFT JOIN dim_localizacao l ON s.uf_infracao = l.uf_infracao AND s.br_infracao = l.br_infracao
    AND s.km_infracao = l.km_infracao AND s.municipio = l.municipio AND s.regiao_infracao = l.regiao_infracao
    AND s.sentido_trafego = l.sentido_trafego
  LEFT JOIN dim_infracao i ON s.codigo_infracao = i.codigo_infracao
  LEFT JOIN dim_infrator v ON s.indicador_veiculo_estrangeiro = v.indicador_veiculo_estrangeiro AND s.uf_placa = v.uf_placa
    AND s.descricao_especie_veiculo = v.descricao_especie_veiculo AND s.descricao_marca_veiculo = v.descricao_marca_veiculo
    AND s.descricao_tipo_veiculo = v.descricao_tipo_veiculo AND s.descricao_modelo_veiculo = v.descricao_modelo_veiculo
    AND s.indicador_abordagem = v.indicador_abordagem AND s.assinatura_auto = v.assinatura_auto
)"""


def with_prepared(select: str) -> str:
    return f"WITH {FINES_RAW_CTE},{PREPARED_SQL_CTE}\n{select}"


def with_frame(select: str) -> str:
    return f"WITH {FINES_RAW_CTE},{PREPARED_FRAME_CTE}\n{select}"


def with_star(select: str) -> str:
    return f"WITH {FINES_RAW_CTE},{PREPARED_SQL_CTE},{STAR_CTE}\n{select}"


ORACLE: dict[str, str] = {}
ORACLE["prepared_sql"] = with_prepared("SELECT * FROM prepared")
ORACLE["prepared_frame"] = with_frame("SELECT * FROM fprepared")
ORACLE["dim_time"] = with_star("SELECT * FROM dim_tempo")
ORACLE["dim_location"] = with_star("SELECT * FROM dim_localizacao")
ORACLE["dim_offence"] = with_star("SELECT * FROM dim_infracao")
ORACLE["dim_offender"] = with_star("SELECT * FROM dim_infrator")
ORACLE["fact_sql"] = with_star("SELECT * FROM fato_multa")


# ---------------------------------------------------------------------------
# Exact rounding helpers (same integer formula as functions.rounding)
# ---------------------------------------------------------------------------
def rr(num: str, den: str, scale: int = 2) -> str:
    """round(num/den, scale) half away from zero, as DECIMAL(20, scale); NULL for a 0/NULL denominator."""
    f = 10**scale
    unit = "0." + "0" * (scale - 1) + "1" if scale > 0 else "1"
    core = f"sign({num}) * sign({den}) * ((abs({num}) * {2 * f} + abs({den})) // (2 * abs({den})))"
    return (
        f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL THEN NULL "
        f"ELSE CAST(CAST({core} AS DECIMAL(20,0)) * {unit} AS DECIMAL(20,{scale})) END)"
    )


def units(x: str, digits: int = 2) -> str:
    return f"CAST(({x}) * {10 ** digits} AS BIGINT)"


def mean2(x: str, cond: str | None = None, digits: int = 2) -> str:
    v = x if cond is None else f"CASE WHEN {cond} THEN {x} END"
    if digits == 6:  # DOUBLE: no exact mean for a group with a value of 1e15 or more
        exact = f"CAST(CASE WHEN abs({v}) < 1e15 THEN ({v}) * 1000000 END AS HUGEINT)"
        return f"CASE WHEN MAX(abs({v})) < 1e15 THEN {rr(f'SUM({exact})', f'(COUNT({v}) * 1000000)', 2)} END"
    return rr(f"SUM({units(v, digits)})", f"(COUNT({v}) * {10 ** digits})", 2)


FT = "fato_multa f JOIN dim_tempo t ON t.id_tempo_sk = f.id_tempo_sk"
FL = "JOIN dim_localizacao l ON l.id_localizacao_sk = f.id_localizacao_sk"
FV = "fato_multa f JOIN dim_infrator v ON v.id_infrator_sk = f.id_infrator_sk"
FI = "fato_multa f JOIN dim_infracao i ON i.id_infracao_sk = f.id_infracao_sk"

Q1_G = f"""q1g AS (
  SELECT t.ano, l.uf_infracao, COUNT(*) AS total_autos, CAST(SUM(f.qtd_infracoes) AS BIGINT) AS total_infracoes
  FROM {FT} {FL}
  WHERE l.uf_infracao NOT IN {lst(V.REPORT_EXCLUDED_STATES)}
  GROUP BY t.ano, l.uf_infracao
), q1w AS (
  SELECT *, LAG(total_infracoes) OVER (PARTITION BY uf_infracao ORDER BY ano) AS prev FROM q1g
), q1 AS (
  SELECT ano, {region_case('uf_infracao', V.NOT_IDENTIFIED)} AS regiao, uf_infracao, total_autos, total_infracoes,
    {rr('(total_infracoes - prev) * 100', 'prev', 2)} AS variacao_pct_ano_anterior
  FROM q1w
)"""

def _star_with(ctes: str, select: str) -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {FINES_RAW_CTE},{PREPARED_SQL_CTE},{STAR_CTE}{extra}\n{select}"


ORACLE["report_q1"] = _star_with(Q1_G, "SELECT * FROM q1")
_YEARS = [2022, 2023, 2024]  # the years of fines_raw
_pivot = ", ".join(f'CAST(SUM(CASE WHEN ano = {y} THEN total_infracoes END) AS BIGINT) AS "{y}"' for y in _YEARS)
ORACLE["report_q1b"] = _star_with(
    Q1_G + f""", q1p AS (SELECT regiao, {_pivot} FROM q1 GROUP BY regiao)""",
    f'SELECT *, {rr(f"""("{_YEARS[-1]}" - "{_YEARS[0]}") * 100""", f'"{_YEARS[0]}"', 1)} '
    f"AS var_{str(_YEARS[0])[-2:]}_{str(_YEARS[-1])[-2:]}_pct FROM q1p",
)
_pos = "CASE regiao " + " ".join(f"WHEN {q(r)} THEN {i + 1}" for i, r in enumerate(V.STACK_ORDER)) + " ELSE 0 END"
ORACLE["report_q1c"] = _star_with(
    Q1_G
    + f""", q1r AS (SELECT ano, regiao, CAST(SUM(total_infracoes) AS BIGINT) AS total_infracoes, {_pos} AS pos
             FROM q1 GROUP BY ano, regiao),
q1s AS (SELECT ano, regiao, total_infracoes,
          CAST(coalesce(SUM(total_infracoes) OVER (PARTITION BY ano ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base
        FROM q1r WHERE pos > 0)""",
    "SELECT ano, regiao, CAST(total_infracoes AS DOUBLE) / 1000000.0 AS total_infracoes_m, CAST(base AS DOUBLE) / 1000000.0 AS base_m FROM q1s",
)

def q2_cte(digits: int = 2, max_type: str = "DECIMAL(10,2)") -> str:
    return f"""q2 AS (
  SELECT v.descricao_especie_veiculo AS especie_veiculo, v.descricao_tipo_veiculo AS tipo_veiculo,
    v.indicador_veiculo_estrangeiro AS estrangeiro, COUNT(*) AS total_infracoes,
    {mean2('f.excesso_verificado', digits=digits)} AS media_excesso_kmh,
    CAST(MAX(f.excesso_verificado) AS {max_type}) AS maior_excesso_kmh
  FROM {FV}
  WHERE f.excesso_verificado > {V.EXCESS_RANGE[0]} AND f.excesso_verificado <= {V.EXCESS_RANGE[1]}
    AND v.descricao_especie_veiculo NOT IN {lst(V.REPORT_EXCLUDED_LABELS)}
    AND v.descricao_tipo_veiculo NOT IN {lst(V.REPORT_EXCLUDED_LABELS)}
  GROUP BY 1, 2, 3
  HAVING COUNT(*) >= {V.MIN_GROUP_ROWS}
)"""


Q2_G = q2_cte()
ORACLE["report_q2"] = _star_with(Q2_G, "SELECT * FROM q2")
_fcol = "CASE estrangeiro " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in V.FOREIGN_COLOURS.items()) + f" ELSE {q(V.DEFAULT_COLOUR)} END"
ORACLE["report_q2b"] = _star_with(
    Q2_G,
    f"SELECT *, especie_veiculo || ' / ' || tipo_veiculo AS label, {_fcol} AS cor FROM q2 "
    "ORDER BY media_excesso_kmh DESC NULLS LAST, especie_veiculo, tipo_veiculo, estrangeiro LIMIT 15",
)
ORACLE["report_q3"] = _star_with(
    "",
    f"SELECT v.descricao_especie_veiculo, v.descricao_tipo_veiculo, f.excesso_verificado AS excesso_kmh FROM {FV} "
    f"WHERE f.excesso_verificado > {V.OUTLIER_EXCESS} "
    "ORDER BY excesso_kmh DESC, v.descricao_especie_veiculo, v.descricao_tipo_veiculo LIMIT 20",
)
def q4_cte(digits: int = 2, max_type: str = "DECIMAL(10,2)") -> str:
    return f"""q4 AS (
  SELECT i.codigo_infracao, i.descricao_infracao, COUNT(*) AS total_autuacoes,
    {mean2('f.excesso_verificado', 'f.excesso_verificado <> 0', digits)} AS media_excesso_kmh,
    CAST(MAX(f.excesso_verificado) AS {max_type}) AS maior_excesso_kmh
  FROM {FI}
  GROUP BY 1, 2
)"""


Q4_G = q4_cte()
ORACLE["report_q4"] = _star_with(Q4_G, "SELECT * FROM q4 ORDER BY total_autuacoes DESC, codigo_infracao, descricao_infracao LIMIT 20")
ORACLE["report_q4b"] = _star_with(
    Q4_G,
    f"SELECT codigo_infracao, '[' || CAST(codigo_infracao AS VARCHAR) || '] ' || substr(descricao_infracao, 1, {V.LABEL_PREFIX_CHARS}) || '...' AS label, "
    "total_autuacoes FROM q4 ORDER BY total_autuacoes DESC, codigo_infracao, descricao_infracao LIMIT 10",
)
ORACLE["report_q5"] = _star_with(
    "",
    f"SELECT t.is_feriado, t.dia_semana, COUNT(f.numero_auto) AS total_multas, {mean2('f.excesso_verificado')} AS media_excesso_velocidade_kmh "
    f"FROM {FT} JOIN dim_infracao i ON i.id_infracao_sk = f.id_infracao_sk GROUP BY 1, 2",
)
ORACLE["report_q6"] = _star_with(
    f"""q6 AS (SELECT l.uf_infracao, t.ano, t.trimestre, COUNT(f.numero_auto) AS total_multas FROM {FT} {FL} GROUP BY 1, 2, 3)""",
    "SELECT *, total_multas - LAG(total_multas) OVER (PARTITION BY uf_infracao ORDER BY ano, trimestre) AS variacao_trimestre_anterior FROM q6",
)
ORACLE["report_q7"] = _star_with(
    f"""q7 AS (SELECT v.descricao_especie_veiculo, v.descricao_tipo_veiculo, v.indicador_abordagem, v.indicador_veiculo_estrangeiro,
            COUNT(f.numero_auto) AS total_multas FROM {FV} GROUP BY 1, 2, 3, 4)""",
    f"SELECT *, {rr('total_multas * 100', '(SELECT SUM(total_multas) FROM q7)', 2)} AS pct_do_total FROM q7",
)
ORACLE["report_q8"] = _star_with(
    f"""q8 AS (SELECT i.codigo_infracao, i.descricao_infracao, i.enquadramento_infracao, COUNT(f.numero_auto) AS total_multas
            FROM {FI} GROUP BY 1, 2, 3)""",
    f"SELECT *, {rr('total_multas * 100', '(SELECT SUM(total_multas) FROM q8)', 2)} AS pct_do_total FROM q8 "
    "ORDER BY total_multas DESC, codigo_infracao LIMIT 10",
)
ORACLE["report_q9"] = _star_with(
    f"""q9 AS (SELECT v.descricao_marca_veiculo, v.descricao_modelo_veiculo, COUNT(f.numero_auto) AS total_multas FROM {FV}
            WHERE v.descricao_marca_veiculo IS NOT NULL AND v.descricao_marca_veiculo <> {q(NI)} GROUP BY 1, 2),
q9r AS (SELECT *, row_number() OVER (ORDER BY total_multas DESC, descricao_marca_veiculo, descricao_modelo_veiculo) AS ranking FROM q9)""",
    "SELECT ranking, descricao_marca_veiculo, descricao_modelo_veiculo, total_multas FROM q9r WHERE ranking <= 10",
)


# ---------------------------------------------------------------------------
# Generic operators on the TPC-H-like tables
# ---------------------------------------------------------------------------
def _plain(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}" if ctes else select


ORACLE["share_by_brand"] = _plain(
    "li AS (SELECT l_partkey, SUM(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1), "
    "b AS (SELECT p_brand, CAST(SUM(q) AS BIGINT) AS total_qty FROM li JOIN part ON l_partkey = p_partkey GROUP BY 1)",
    f"SELECT p_brand, total_qty, {rr('total_qty * 100', '(SELECT SUM(total_qty) FROM b)', 2)} AS pct_do_total FROM b",
)
_ONC = "orders JOIN customer ON o_custkey = c_custkey"
ORACLE["yoy_by_nation"] = _plain(
    f"g AS (SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS ano, COUNT(*) AS total_pedidos FROM {_ONC} "
    "JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), "
    "w AS (SELECT *, LAG(total_pedidos) OVER (PARTITION BY n_name ORDER BY ano) AS prev FROM g)",
    f"SELECT n_name, ano, total_pedidos, {rr('(total_pedidos - prev) * 100', 'prev', 2)} AS variacao_pct_ano_anterior FROM w",
)
ORACLE["qoq_by_segment"] = _plain(
    f"g AS (SELECT c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre, "
    f"COUNT(*) AS total_pedidos FROM {_ONC} GROUP BY 1, 2, 3)",
    "SELECT *, total_pedidos - LAG(total_pedidos) OVER (PARTITION BY c_mktsegment ORDER BY ano, trimestre) AS variacao_trimestre_anterior FROM g",
)
ORACLE["top_parts"] = _plain(
    "li AS (SELECT l_partkey, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_qty FROM lineitem GROUP BY 1 "
    "ORDER BY total_qty DESC, l_partkey LIMIT 10)",
    "SELECT p_partkey, p_name, total_qty FROM li JOIN part ON p_partkey = l_partkey",
)
ORACLE["rank_brands"] = _plain(
    "g AS (SELECT p_brand, COUNT(*) AS total_linhas FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), "
    "r AS (SELECT row_number() OVER (ORDER BY total_linhas DESC, p_brand) AS ranking, p_brand, total_linhas FROM g)",
    "SELECT * FROM r WHERE ranking <= 10",
)
_REGION_G = (
    f"g AS (SELECT r_name, r_regionkey, CAST(year(o_orderdate) AS INTEGER) AS ano, COUNT(*) AS total_pedidos FROM {_ONC} "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)"
)
_OYEARS = list(range(1995, 2002))
_opiv = ", ".join(f'SUM(CASE WHEN ano = {y} THEN total_pedidos END) AS "{y}"' for y in _OYEARS)
ORACLE["region_year_pivot"] = _plain(
    _REGION_G + f", p AS (SELECT r_name, {_opiv} FROM g GROUP BY 1)",
    "SELECT r_name, "
    + ", ".join(f'CAST(coalesce("{y}", 0) AS BIGINT) AS "{y}"' for y in _OYEARS)
    + f', {rr(f"""("{_OYEARS[-1]}" - "{_OYEARS[0]}") * 100""", f'"{_OYEARS[0]}"', 1)} AS var_pct FROM p',
)
ORACLE["stack_by_year"] = _plain(
    _REGION_G,
    "SELECT ano, r_name, total_pedidos, CAST(coalesce(SUM(total_pedidos) OVER (PARTITION BY ano ORDER BY r_regionkey "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base FROM g",
)
ORACLE["outlier_rows"] = (
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity > 0 AND l_quantity <= 50 "
    "AND l_extendedprice > 104000.0 ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20"
)
ORACLE["mean_nonzero"] = _plain(
    "d AS (SELECT l_returnflag, CAST(l_discount AS DECIMAL(10,2)) AS d FROM lineitem)",
    "SELECT l_returnflag, COUNT(*) AS linhas, COUNT(CASE WHEN d <> 0 THEN d END) AS linhas_nao_zero, "
    f"{rr('SUM(CASE WHEN d <> 0 THEN CAST(d * 100 AS BIGINT) END)', '(COUNT(CASE WHEN d <> 0 THEN d END) * 100)', 4)} AS media_desconto_nao_zero, "
    "MAX(d) AS maior_desconto FROM d GROUP BY 1",
)
ORACLE["semi_exists"] = "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"
ORACLE["orphan_rows"] = (
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)"
)


# ---------------------------------------------------------------------------
# Rule tables, parsers, calendar over the raw fines
# ---------------------------------------------------------------------------
def _rule(col: str, sql_e: str, frame_e: str) -> str:
    return with_raw(
        f"SELECT {col} AS before, {sql_e} AS after_sql, {frame_e} AS after_frame, COUNT(*) AS n FROM fines_raw GROUP BY 1, 2, 3"
    )


def with_raw(select: str) -> str:
    return f"WITH {FINES_RAW_CTE}\n{select}"


_u = lambda c: f"upper({pystrip(c)})"
ORACLE["scalar_region"] = _rule(
    "uf_infracao", region_case(f"coalesce(uf_infracao, {q(NI)})", NI), region_case(_u("uf_infracao"), V.NOT_INFORMED_FRAME)
)
ORACLE["scalar_direction"] = _rule(
    "sentido_trafego",
    _dir_sql("sentido_trafego", NI, lambda c: f"trim({c})"),
    _dir_sql("sentido_trafego", V.NOT_INFORMED_FRAME, pystrip),
)
ORACLE["scalar_doc_type"] = _rule("assinatura_auto", _doc_sql("assinatura_auto"), _doc_frame("assinatura_auto"))
_sp = "descricao_especie_veiculo"
ORACLE["scalar_species"] = _rule(_sp, _species_sql(f"coalesce({_sp}, {q(NI)})"), _species_frame(_sp))
_tp = "descricao_tipo_veiculo"
ORACLE["scalar_missing_terms"] = _rule(_tp, _terms_sql(f"coalesce({_tp}, {q(NI)})", V.MISSING_TERMS), _terms_frame(_tp))
_mk = "descricao_marca_veiculo"
ORACLE["scalar_make"] = _rule(_mk, _terms_sql(f"coalesce({_mk}, {q(NI)})", V.MISSING_TERMS_MAKE_SQL), _terms_frame(_mk))
ORACLE["scalar_plate"] = _rule("uf_placa", _plate_sql("uf_placa"), _plate_frame("uf_placa"))
_fg = "indicador_veiculo_estrangeiro"
ORACLE["scalar_foreign"] = _rule(_fg, _foreign_sql(_fg), _foreign_sql(_fg))
ORACLE["parse_km_both"] = _rule("km_infracao", _guarded_int("km_infracao", 0), _km_frame("km_infracao"))


def _fields(specs) -> str:
    parts = [
        f"SELECT {q(f)} AS field, {f} AS before, CAST({s} AS VARCHAR) AS after_sql, CAST({fr} AS VARCHAR) AS after_frame, "
        f"COUNT(*) AS n FROM fines_raw GROUP BY 1, 2, 3, 4"
        for f, s, fr in specs
    ]
    return with_raw(" UNION ALL ".join(parts))


_HOUR_SQL = (
    "CAST(CASE WHEN hora_infracao IS NULL THEN NULL WHEN regexp_full_match(hora_infracao, '-?[0-9]+') "
    "THEN coalesce(TRY_CAST(hora_infracao AS INTEGER), 0) ELSE 0 END AS INTEGER)"
)
ORACLE["parse_ints"] = _fields([
    ("codigo_infracao", _guarded_int("codigo_infracao", 0), _frame_int("codigo_infracao", 0)),
    ("qtd_infracoes", _guarded_int("qtd_infracoes", 1), _frame_int("qtd_infracoes", 1)),
    ("hora_infracao", _HOUR_SQL, "hora_infracao"),
])
ORACLE["parse_decimal_comma"] = _fields([(c, _guarded_dec(c), _dec_frame(c)) for c in ("medicao_considerada", "excesso_verificado")])
_ISO = "CASE WHEN regexp_full_match(data_infracao, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(data_infracao AS DATE) END"
ORACLE["parse_date"] = with_raw(f"SELECT data_infracao AS before, {_ISO} AS after, COUNT(*) AS n FROM fines_raw GROUP BY 1, 2")
ORACLE["holiday_flag"] = with_prepared(
    f"SELECT data_infracao, {holiday_case('data_infracao')} AS feriado_listado, {holiday_case('data_infracao')} AS feriado_calculado, "
    f"{weekday_case('data_infracao')} AS dia_semana FROM (SELECT DISTINCT data_infracao FROM prepared) WHERE {holiday_case('data_infracao')}"
)

# ---------------------------------------------------------------------------
# Profiling and data tests
# ---------------------------------------------------------------------------
from starmart.schemas import RAW_COLUMNS as _RAW  # noqa: E402
from starmart.schemas import RAW_COLUMNS_AND_HEADERS as HEADERS  # noqa: E402

_nulls = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n{i}" for i, c in enumerate(_RAW))
ORACLE["profile_nulls"] = (
    f"WITH {FINES_RAW_CTE}, a AS (SELECT COUNT(*) AS total_rows, {_nulls} FROM fines_raw)\n"
    + " UNION ALL ".join(
        f"SELECT {q(c)} AS column_name, n{i} AS nulls, {rr(f'n{i} * 100', 'total_rows', 2)} AS pct FROM a WHERE n{i} > 0"
        for i, c in enumerate(_RAW)
    )
)
_MIXED = " , ".join(
    f"try_strptime(data_infracao, {q(f)})" for f in ("%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y")
)
_LOAD = "CAST(2022 + coalesce(CAST(substr(numero_auto, 2, 8) AS INT), 0) % 3 AS INT)"
ORACLE["profile_dates"] = (
    f"WITH {FINES_RAW_CTE}, d AS (SELECT CAST(coalesce({_MIXED}) AS DATE) AS d, {_LOAD} AS ano FROM fines_raw)\n"
    "SELECT 'invalid_or_null' AS metric, COUNT(*) FILTER (WHERE d IS NULL) AS value FROM d UNION ALL "
    "SELECT 'outside_year', COUNT(*) FILTER (WHERE d IS NOT NULL AND year(d) <> ano) FROM d"
)
ORACLE["profile_hours"] = (
    f"WITH {FINES_RAW_CTE}, h AS (SELECT {_numtext('hora_infracao')} AS h FROM fines_raw)\n"
    f"SELECT 'not_numeric' AS metric, COUNT(*) FILTER (WHERE h IS NULL) AS value FROM h UNION ALL "
    f"SELECT 'out_of_range', COUNT(*) FILTER (WHERE h < {V.HOUR_RANGE[0]} OR h > {V.HOUR_RANGE[1]}) FROM h"
)
ORACLE["profile_duplicates"] = with_raw(
    "SELECT 'duplicated_keys' AS metric, CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS value "
    "FROM (SELECT numero_auto, COUNT(*) AS n FROM fines_raw GROUP BY 1)"
)


def _describe(c: str) -> str:
    return (
        f"(WITH c AS (SELECT {c} AS v, COUNT(*) AS n FROM fines_raw WHERE {c} IS NOT NULL GROUP BY 1) "
        f'SELECT {q(c)} AS column_name, CAST(SUM(n) AS BIGINT) AS "count", COUNT(*) AS "unique", '
        f'(SELECT MIN(v) FROM c WHERE n = (SELECT MAX(n) FROM c)) AS top, MAX(n) AS freq FROM c)'
    )


ORACLE["profile_text"] = with_raw(" UNION ALL ".join(f"SELECT * FROM {_describe(c)}" for c in ("medicao_infracao", "medicao_considerada")))
_CATS = ["uf_infracao", "uf_placa", "indicador_veiculo_estrangeiro", "indicador_abordagem", "assinatura_auto", "sentido_trafego"]
ORACLE["profile_values"] = with_raw(
    "SELECT DISTINCT column_name, value FROM ("
    + " UNION ALL ".join(f"SELECT {q(c)} AS column_name, CAST({c} AS VARCHAR) AS value FROM fines_raw" for c in _CATS)
    + ") WHERE value IS NOT NULL"
)
ORACLE["profile_terms"] = with_raw(
    f"SELECT {_u(_mk)} AS value, COUNT(*) AS n FROM fines_raw WHERE {_u(_mk)} IN ('-1', 'NA', 'NAO INFORMADO', 'NÃO ENCONTRADO', 'NÃO INFORMADO') GROUP BY 1"
)
ORACLE["test_not_null"] = with_raw("SELECT * FROM fines_raw WHERE numero_auto IS NULL")
ORACLE["test_unique"] = with_prepared(
    "SELECT numero_auto, COUNT(*) AS n_records FROM prepared WHERE numero_auto IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"
)
ORACLE["test_accepted"] = with_prepared(
    "SELECT indicador_veiculo_estrangeiro, COUNT(*) AS n_records FROM prepared "
    "WHERE indicador_veiculo_estrangeiro IS NOT NULL AND indicador_veiculo_estrangeiro NOT IN ('S', 'N', 'N/I') GROUP BY 1"
)
ORACLE["union_evolving"] = with_raw(
    "SELECT numero_auto, data_infracao, uf_infracao, km_infracao, CAST(NULL AS VARCHAR) AS municipio FROM fines_raw UNION ALL "
    "SELECT numero_auto, data_infracao, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), municipio FROM fines_raw"
)
ORACLE["append_then_distinct"] = with_raw("SELECT DISTINCT * FROM (SELECT * FROM fines_raw UNION ALL SELECT * FROM fines_raw)")


def _suite_sql() -> str:
    from starmart.operators.quality import STAR_CHECKS

    parts = []
    for c in STAR_CHECKS:
        head = f"SELECT {q(c.model)} AS model, {q(c.column)} AS column_name, {q(c.test)} AS test, "
        if c.test == "not_null":
            parts.append(head + f"COUNT(*) AS failures FROM {c.model} WHERE {c.column} IS NULL")
        elif c.test == "unique":
            parts.append(
                head + f"CAST(coalesce(SUM(n), 0) AS BIGINT) FROM (SELECT {c.column}, COUNT(*) AS n FROM {c.model} "
                f"WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"
            )
        elif c.test == "accepted_values":
            parts.append(
                head + f"CAST(coalesce(SUM(n), 0) AS BIGINT) FROM (SELECT {c.column}, COUNT(*) AS n FROM {c.model} "
                f"WHERE {c.column} IS NOT NULL AND {c.column} NOT IN {lst(c.values)} GROUP BY 1)"
            )
        else:
            pc = c.parent_column or c.column
            parts.append(
                head + f"COUNT(*) FROM {c.model} x WHERE x.{c.column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {c.parent} p WHERE p.{pc} = x.{c.column})"
            )
    return " UNION ALL ".join(parts)


ORACLE["test_suite"] = with_star(_suite_sql())

_LY = _YEARS
_lpiv = ", ".join(f'CAST(SUM(CASE WHEN ano = {y} THEN total_infracoes END) AS BIGINT) AS "{y}"' for y in _LY)
_rcol = "CASE regiao " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in V.REGION_COLOURS.items()) + f" ELSE {q(V.DEFAULT_COLOUR)} END"
ORACLE["labels_and_formats"] = _star_with(
    Q1_G + f", lp AS (SELECT regiao, {_lpiv} FROM q1 GROUP BY regiao), "
    f"""lv AS (SELECT *, CAST({rr('("2024" - "2022") * 100', '"2022"', 1)} AS DECIMAL(20,1)) AS v FROM lp)""",
    "SELECT regiao, format('{:,}', \"2024\") AS total_ultimo_ano, replace(format('{:,}', \"2024\"), ',', '.') AS total_ultimo_ano_br, "
    f"CAST({rr('\"2024\"', '1000000', 1)} AS VARCHAR) || 'M' AS total_milhoes, "
    "CASE WHEN v > 0 THEN '+' || CAST(v AS VARCHAR) || '%' ELSE CAST(v AS VARCHAR) || '%' END AS variacao, "
    f"{_rcol} AS cor FROM lv",
)

# ---------------------------------------------------------------------------
# Star under the frame rules: 0-based keys, NULL-safe key matching
# ---------------------------------------------------------------------------
_NL = lambda cols: ", ".join(f"{c} NULLS LAST" for c in cols)
_LOC = ["uf_infracao", "br_infracao", "km_infracao", "municipio", "regiao_infracao", "sentido_trafego"]
_LOC_ORDER = ["uf_infracao", "municipio", "br_infracao", "km_infracao", "regiao_infracao", "sentido_trafego"]
_OFR = ["indicador_veiculo_estrangeiro", "uf_placa", "descricao_especie_veiculo", "descricao_marca_veiculo",
        "descricao_tipo_veiculo", "descricao_modelo_veiculo", "indicador_abordagem", "assinatura_auto"]
FRAME_STAR_CTE = f"""
fdim_tempo AS (SELECT row_number() OVER (ORDER BY data_infracao) - 1 AS id_tempo_sk, data_infracao
               FROM (SELECT DISTINCT data_infracao FROM fprepared)),
fdim_loc AS (SELECT row_number() OVER (ORDER BY {_NL(_LOC_ORDER)}) - 1 AS id_localizacao_sk, {", ".join(_LOC)}
             FROM (SELECT DISTINCT {", ".join(_LOC)} FROM fprepared)),
fdim_inf AS (SELECT row_number() OVER (ORDER BY codigo_infracao NULLS LAST) - 1 AS id_infracao_sk, codigo_infracao
             FROM (SELECT DISTINCT codigo_infracao FROM fprepared)),
fdim_ofr AS (SELECT row_number() OVER (ORDER BY {_NL(_OFR)}) - 1 AS id_infrator_sk, {", ".join(_OFR)}
             FROM (SELECT DISTINCT {", ".join(_OFR)} FROM fprepared))"""


def with_frame_star(select: str) -> str:
    return f"WITH {FINES_RAW_CTE},{PREPARED_FRAME_CTE},{FRAME_STAR_CTE}\n{select}"


_ns = lambda a, b, cols: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)
ORACLE["dim_location_frame"] = with_frame_star("SELECT * FROM fdim_loc")
ORACLE["dim_offender_frame"] = with_frame_star("SELECT * FROM fdim_ofr")
ORACLE["fact_null_safe"] = with_frame_star(
    "SELECT t.id_tempo_sk, l.id_localizacao_sk, i.id_infracao_sk, v.id_infrator_sk, s.numero_auto, s.qtd_infracoes, "
    "s.medicao_considerada, s.excesso_verificado FROM fprepared s "
    "LEFT JOIN fdim_tempo t ON s.data_infracao IS NOT DISTINCT FROM t.data_infracao "
    f"LEFT JOIN fdim_loc l ON {_ns('s', 'l', _LOC)} "
    "LEFT JOIN fdim_inf i ON s.codigo_infracao IS NOT DISTINCT FROM i.codigo_infracao "
    f"LEFT JOIN fdim_ofr v ON {_ns('s', 'v', _OFR)}"
)


def _profile_report_sql() -> str:
    """Per load year: every section of the profile."""
    y = "ano_carga"
    nulls = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n{i}" for i, c in enumerate(_RAW))
    rows = []
    for i, c in enumerate(_RAW):
        rows.append(f"SELECT {y}, 'nulls' AS section, {q(c)} AS column_name, 'nulls' AS metric, CAST(n{i} AS VARCHAR) AS value FROM a WHERE n{i} > 0")
        rows.append(f"SELECT {y}, 'nulls', {q(c)}, 'pct', CAST({rr(f'n{i} * 100', 'total_rows', 2)} AS VARCHAR) FROM a WHERE n{i} > 0")
    one = lambda section, col, metric, cond: f"SELECT {y}, {q(section)}, {q(col)}, {q(metric)}, CAST(COUNT(*) FILTER (WHERE {cond}) AS VARCHAR) FROM r GROUP BY 1"
    rows += [
        one("dates", "data_infracao", "invalid_or_null", "d IS NULL"), one("dates", "data_infracao", "outside_year", f"d IS NOT NULL AND year(d) <> {y}"),
        one("hours", "hora_infracao", "not_numeric", "h IS NULL"), one("hours", "hora_infracao", "out_of_range", f"h < {V.HOUR_RANGE[0]} OR h > {V.HOUR_RANGE[1]}"),
        f"SELECT {y}, 'duplicates', 'numero_auto', 'duplicated_keys', CAST(SUM(n - 1) AS VARCHAR) FROM (SELECT {y}, numero_auto, COUNT(*) AS n FROM r GROUP BY 1, 2) GROUP BY 1",
    ]
    for c in ("medicao_infracao", "medicao_considerada"):
        counts = f"(SELECT {y}, {c} AS v, COUNT(*) AS n FROM r WHERE {c} IS NOT NULL GROUP BY 1, 2)"
        for m, e in (("count", "SUM(n)"), ("unique", "COUNT(*)"), ("freq", "MAX(n)"), ("top", "arg_min(v, {'a': -n, 'b': v})")):
            rows.append(f"SELECT {y}, 'describe', {q(c)}, {q(m)}, CAST({e} AS VARCHAR) FROM {counts} GROUP BY 1")
    for c in _CATS:
        rows.append(f"SELECT DISTINCT {y}, 'values', {q(c)}, 'value', {c} FROM r WHERE {c} IS NOT NULL")
    order = ", ".join(f"{c} NULLS LAST" for c in ["numero_auto", *[c for c in _RAW if c != "numero_auto"]])
    for c, e, n in (("data_infracao", "CAST(d AS VARCHAR)", 5), *[(c, c, 50) for c in ("numero_auto", "medicao_infracao", "medicao_considerada")]):
        rows.append(f"SELECT {y}, 'sample', {q(c)}, printf('%03d', i), {e} FROM s WHERE i <= {n}")
    return (
        f"WITH {FINES_RAW_CTE}, r AS (SELECT *, {_LOAD} AS {y}, CAST(coalesce({_MIXED}) AS DATE) AS d, {_numtext('hora_infracao')} AS h FROM fines_raw), "
        f"a AS (SELECT {y}, COUNT(*) AS total_rows, {nulls} FROM r GROUP BY 1), "
        f"s AS (SELECT *, row_number() OVER (PARTITION BY {y} ORDER BY {order}) AS i FROM r)\n" + " UNION ALL ".join(rows)
    )


ORACLE["profile_report"] = _profile_report_sql()
ORACLE["csv_roundtrip"] = with_raw("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _RAW) + " FROM fines_raw")


# ---------------------------------------------------------------------------
# Notebook analyses on the star loaded under the frame rules (same table names)
# ---------------------------------------------------------------------------
FRAME_STAR_NAMED_CTE = f"""
dim_tempo AS (
  SELECT row_number() OVER (ORDER BY data_infracao) - 1 AS id_tempo_sk, data_infracao,
    CAST(year(data_infracao) AS INTEGER) AS ano
  FROM (SELECT DISTINCT data_infracao FROM fprepared)
),
dim_localizacao AS (SELECT * FROM fdim_loc),
dim_infracao AS (
  SELECT row_number() OVER (ORDER BY codigo_infracao NULLS LAST) - 1 AS id_infracao_sk, codigo_infracao,
    descricao_infracao, enquadramento_infracao
  FROM (SELECT codigo_infracao, max(descricao_abreviada_infracao) AS descricao_infracao,
          max(enquadramento_infracao) AS enquadramento_infracao FROM fprepared GROUP BY codigo_infracao)
),
dim_infrator AS (SELECT * FROM fdim_ofr),
fato_multa AS (
  SELECT t.id_tempo_sk, l.id_localizacao_sk, i.id_infracao_sk, v.id_infrator_sk, s.numero_auto, s.qtd_infracoes,
    s.medicao_considerada, s.excesso_verificado
  FROM fprepared s
  LEFT JOIN dim_tempo t ON s.data_infracao IS NOT DISTINCT FROM t.data_infracao
  LEFT JOIN fdim_loc l ON {_ns('s', 'l', _LOC)}
  LEFT JOIN dim_infracao i ON s.codigo_infracao IS NOT DISTINCT FROM i.codigo_infracao
  LEFT JOIN fdim_ofr v ON {_ns('s', 'v', _OFR)}
)"""


def _frame_star_with(ctes: str, select: str) -> str:
    return f"WITH {FINES_RAW_CTE},{PREPARED_FRAME_CTE},{FRAME_STAR_CTE},{FRAME_STAR_NAMED_CTE},\n{ctes}\n{select}"


ORACLE["report_q1_frame"] = _frame_star_with(Q1_G, "SELECT * FROM q1")
ORACLE["report_q2_frame"] = _frame_star_with(q2_cte(6, "DOUBLE"), "SELECT * FROM q2")
ORACLE["report_q4_frame"] = _frame_star_with(
    q4_cte(6, "DOUBLE"), "SELECT * FROM q4 ORDER BY total_autuacoes DESC, codigo_infracao, descricao_infracao LIMIT 20"
)


def _frame_variant(sql_version: str, ctes: str) -> str:
    """Reuse a star report's final SELECT over the frame-rule star with the given report CTEs."""
    select = sql_version.rsplit("\n", 1)[1]
    return _frame_star_with(ctes, select)


ORACLE["report_q1b_frame"] = _frame_variant(
    ORACLE["report_q1b"], Q1_G + f""", q1p AS (SELECT regiao, {_pivot} FROM q1 GROUP BY regiao)"""
)
ORACLE["report_q1c_frame"] = _frame_star_with(
    Q1_G
    + f""", q1r AS (SELECT ano, regiao, CAST(SUM(total_infracoes) AS BIGINT) AS total_infracoes, {_pos} AS pos
             FROM q1 GROUP BY ano, regiao),
q1s AS (SELECT ano, regiao, total_infracoes,
          CAST(coalesce(SUM(total_infracoes) OVER (PARTITION BY ano ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base
        FROM q1r WHERE pos > 0)""",
    "SELECT ano, regiao, CAST(total_infracoes AS DOUBLE) / 1000000.0 AS total_infracoes_m, CAST(base AS DOUBLE) / 1000000.0 AS base_m FROM q1s",
)
ORACLE["report_q2b_frame"] = _frame_star_with(
    q2_cte(6, "DOUBLE"),
    f"SELECT *, especie_veiculo || ' / ' || tipo_veiculo AS label, {_fcol} AS cor FROM q2 "
    "ORDER BY media_excesso_kmh DESC NULLS LAST, especie_veiculo, tipo_veiculo, estrangeiro LIMIT 15",
)
ORACLE["report_q4b_frame"] = _frame_star_with(
    q4_cte(6, "DOUBLE"),
    f"SELECT codigo_infracao, '[' || CAST(codigo_infracao AS VARCHAR) || '] ' || substr(descricao_infracao, 1, {V.LABEL_PREFIX_CHARS}) || '...' AS label, "
    "total_autuacoes FROM q4 ORDER BY total_autuacoes DESC, codigo_infracao, descricao_infracao LIMIT 10",
)


# ---------------------------------------------------------------------------
# Published order as a column
# ---------------------------------------------------------------------------
def _ordered(sql: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS ordem FROM ({sql})"


_ORDER = {
    "report_q1": "regiao, ano, uf_infracao",
    "report_q1b": '"2024" DESC NULLS LAST, regiao',
    "report_q2": "media_excesso_kmh DESC NULLS LAST, especie_veiculo, tipo_veiculo, estrangeiro",
    "report_q5": "is_feriado DESC, total_multas DESC, dia_semana",
    "report_q6": "ano DESC, trimestre DESC, total_multas DESC, uf_infracao",
    "report_q7": "total_multas DESC, descricao_especie_veiculo, descricao_tipo_veiculo, indicador_abordagem, indicador_veiculo_estrangeiro",
    "profile_nulls": "pct DESC, column_name",
    "top_parts": "total_qty DESC, p_partkey",
}
for _name, _by in _ORDER.items():
    ORACLE[f"{_name}_ordered"] = _ordered(ORACLE[_name], _by)


# ---------------------------------------------------------------------------
# Seven years and numbers outside the usual ranges
# ---------------------------------------------------------------------------
def _wide(sql: str) -> str:
    return sql.replace(FINES_RAW_SQL, FINES_WIDE_SQL)


_WY = list(range(2020, 2027))
_wpivot = ", ".join(f'CAST(SUM(CASE WHEN ano = {y} THEN total_infracoes END) AS BIGINT) AS "{y}"' for y in _WY)
_wchange = rr('("2026" - "2020") * 100', '"2020"', 1)
ORACLE["prepared_frame_wide"] = _wide(ORACLE["prepared_frame"])
ORACLE["report_q4_frame_wide"] = _wide(ORACLE["report_q4_frame"])
ORACLE["report_q1b_wide"] = _wide(_star_with(Q1_G + f", q1p AS (SELECT regiao, {_wpivot} FROM q1 GROUP BY regiao)", f"SELECT *, {_wchange} AS var_20_26_pct FROM q1p"))
ORACLE["labels_and_formats_wide"] = _wide(_star_with(
    Q1_G + f", lp AS (SELECT regiao, {_wpivot} FROM q1 GROUP BY regiao), lv AS (SELECT *, CAST({_wchange} AS DECIMAL(20,1)) AS v FROM lp)",
    "SELECT regiao, format('{:,}', \"2026\") AS total_ultimo_ano, replace(format('{:,}', \"2026\"), ',', '.') AS total_ultimo_ano_br, "
    f"CAST({rr('\"2026\"', '1000000', 1)} AS VARCHAR) || 'M' AS total_milhoes, "
    "CASE WHEN v > 0 THEN '+' || CAST(v AS VARCHAR) || '%' ELSE CAST(v AS VARCHAR) || '%' END AS variacao, "
    f"{_rcol} AS cor FROM lv",
))


def _replaced_sql() -> str:
    whole = lambda c: f"regexp_full_match({c}, '-?[0-9]+') AND TRY_CAST({c} AS INTEGER) IS NULL"
    cents = lambda c: f"regexp_full_match(replace({c}, ',', '.'), {_NUM_DEC}) AND TRY_CAST(replace({c}, ',', '.') AS DECIMAL(10,2)) IS NULL"
    big = lambda c: f"abs({_numtext(c)}) >= 9223372036854775808.0"
    cases = [("sql", c, whole(c)) for c in ("codigo_infracao", "km_infracao", "qtd_infracoes", "hora_infracao")]
    cases += [("sql", c, cents(c)) for c in ("medicao_considerada", "excesso_verificado")]
    cases += [("frame", c, big(c)) for c in ("codigo_infracao", "qtd_infracoes")]
    return _wide(with_raw(" UNION ALL ".join(f"SELECT {q(r)} AS rules, {q(c)} AS field, COUNT(*) FILTER (WHERE {e}) AS n FROM fines_raw" for r, c, e in cases)))


ORACLE["profile_replaced"] = _replaced_sql()
_INSPECTED = ("descricao_especie_veiculo", "descricao_tipo_veiculo", "descricao_marca_veiculo", "fim_vigencia_infracao")
ORACLE["inspect_values"] = with_raw(" UNION ALL ".join(f"SELECT DISTINCT {_LOAD} AS ano_carga, {q(c)} AS column_name, {c} AS value FROM fines_raw" for c in _INSPECTED))
ORACLE["report_q6_one_year"] = _star_with(
    f"q6 AS (SELECT l.uf_infracao, t.ano, t.trimestre, COUNT(f.numero_auto) AS total_multas FROM {FT} {FL} WHERE t.ano = 2023 GROUP BY 1, 2, 3)",
    "SELECT *, total_multas - LAG(total_multas) OVER (PARTITION BY uf_infracao ORDER BY ano, trimestre) AS variacao_trimestre_anterior FROM q6",
)
ORACLE["sql_over_views"] = with_star(
    f"SELECT t.ano, l.uf_infracao, COUNT(*) AS autos, CAST(SUM(f.qtd_infracoes) AS BIGINT) AS infracoes FROM {FT} {FL} GROUP BY 1, 2"
)

# ---------------------------------------------------------------------------
# Files, sinks, keys, references
# ---------------------------------------------------------------------------
ORACLE["csv_quoting"] = r"""
SELECT 'Q' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS numero_auto,
  CASE l_linenumber % 7 WHEN 0 THEN 'C:\' WHEN 1 THEN 'S "X" Y' WHEN 2 THEN 'a;b;c' WHEN 3 THEN '"' WHEN 4 THEN '\"\;' WHEN 5 THEN '  ' ELSE 'São João' END AS municipio,
  p_name AS descricao_modelo_veiculo, CASE WHEN l_suppkey % 2 = 0 THEN 'SP' ELSE '' END AS uf_infracao
FROM lineitem JOIN part ON l_partkey = p_partkey"""
ORACLE["csv_malformed"] = "SELECT COUNT(*) AS linhas, COUNT(*) FILTER (WHERE l_orderkey % 10 < 2) AS malformadas, COUNT(*) AS com_numero FROM lineitem"
ORACLE["encoding_fallback"] = (
    "SELECT 'E' || CAST(s_suppkey AS VARCHAR) AS numero_auto, 'Ação' AS municipio, 'latin' AS arquivo FROM supplier UNION ALL "
    "SELECT 'E' || CAST(s_suppkey AS VARCHAR), 'A' || chr(65533) || chr(65533) || 'o', 'replaced' FROM supplier"
)
# rows_per_load has no SQL: which half a row goes to is a hash; tests/test_files.py adds the totals up
ORACLE["first_file_header"] = "SELECT * FROM (VALUES " + ", ".join(f"({i}, {q(h)})" for i, (_, h) in enumerate(HEADERS, 1)) + ") t(posicao, coluna)"
ORACLE["sink_partitions"] = """
WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders),
t AS (SELECT * FROM o WHERE ano <> 1997 UNION ALL SELECT * FROM o WHERE ano = 1997 AND o_orderkey % 2 = 0 UNION ALL SELECT * FROM o WHERE ano = 1998)
SELECT ano, COUNT(*) AS linhas, COUNT(DISTINCT o_orderkey) AS pedidos FROM t GROUP BY 1"""
ORACLE["sink_raw_table"] = with_raw("SELECT DISTINCT * FROM fines_raw")
ORACLE["first_seen_keys"] = """
SELECT row_number() OVER (ORDER BY d, k, o_custkey) - 1 AS id_cliente_sk, o_custkey
FROM (SELECT o_custkey, min(o_orderdate) AS d, arg_min(o_orderkey, {'a': o_orderdate, 'b': o_orderkey}) AS k FROM orders GROUP BY 1)"""
ORACLE["orphan_rows_shifted"] = """
WITH m AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey FROM orders)
SELECT o_orderkey, o_custkey FROM m WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)"""
ORACLE["test_relationships"] = """
WITH c AS (SELECT o_orderstatus, CASE WHEN o_custkey % 5 = 0 THEN -o_custkey WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders)
SELECT 'pedidos' AS model, 'o_custkey' AS column_name, 'relationships' AS test, COUNT(*) AS failures FROM c WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'pedidos', 'o_custkey', 'not_null', COUNT(*) FROM c WHERE o_custkey IS NULL
UNION ALL SELECT 'pedidos', 'o_orderstatus', 'accepted_values', COUNT(*) FROM c WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'clientes', 'c_custkey', 'unique', CAST(coalesce(SUM(n), 0) AS BIGINT) FROM (SELECT c_custkey, COUNT(*) AS n FROM customer GROUP BY 1 HAVING COUNT(*) > 1)"""


# ---------------------------------------------------------------------------
# Upkeep: reconciliation, severity, rejects, loads, appended and bucketed stars
# ---------------------------------------------------------------------------
_COMPARED = [
    "uf_infracao", "municipio", "indicador_abordagem", "br_infracao", "assinatura_auto", "sentido_trafego", "indicador_veiculo_estrangeiro", "uf_placa",
    "descricao_especie_veiculo", "descricao_tipo_veiculo", "descricao_marca_veiculo", "descricao_modelo_veiculo", "descricao_abreviada_infracao",
    "enquadramento_infracao", "codigo_infracao", "km_infracao", "qtd_infracoes", "hora_infracao", "medicao_considerada", "excesso_verificado",
    "data_infracao", "dia", "mes", "ano", "trimestre", "dia_semana", "regiao_infracao",
]
_WIDER = {"km_infracao": "DOUBLE", "medicao_considerada": "DOUBLE", "excesso_verificado": "DOUBLE", "codigo_infracao": "BIGINT", "qtd_infracoes": "BIGINT", "hora_infracao": "VARCHAR"}


def _side(name: str, prepared: str) -> str:
    cols = ", ".join(f"CAST({c} AS {_WIDER[c]}) AS {c}" if c in _WIDER else c for c in _COMPARED)
    order = ", ".join(f"{c} NULLS LAST" for c in _COMPARED)
    return f"{name}0 AS (SELECT numero_auto, {cols} FROM ({prepared})), {name} AS (SELECT *, row_number() OVER (PARTITION BY numero_auto ORDER BY {order}) AS place FROM {name}0)"


_PAIRED = f"""WITH {_side('l', ORACLE['prepared_sql'])}, {_side('r', ORACLE['prepared_frame'])}, j AS (
  SELECT coalesce(l.numero_auto, r.numero_auto) AS numero_auto, coalesce(l.place, r.place) AS place, l.place AS lp, r.place AS rp,
    {', '.join(f'l.{c} AS l_{c}, r.{c} AS r_{c}' for c in _COMPARED)}
  FROM l FULL OUTER JOIN r ON l.numero_auto = r.numero_auto AND l.place = r.place
), c AS (
  SELECT *, CASE WHEN lp IS NULL OR rp IS NULL THEN '' ELSE concat_ws(',', {', '.join(f"CASE WHEN l_{c} IS DISTINCT FROM r_{c} THEN {q(c)} END" for c in _COMPARED)}) END AS differs FROM j
), k AS (
  SELECT *, CASE WHEN rp IS NULL THEN 'left_only' WHEN lp IS NULL THEN 'right_only' WHEN differs <> '' THEN 'different' ELSE 'equal' END AS class FROM c
)
"""
ORACLE["reconcile_rules"] = _PAIRED + "SELECT numero_auto, place, class, differs FROM k WHERE class <> 'equal'"
ORACLE["reconcile_classes"] = _PAIRED + "SELECT class, COUNT(*) AS rows FROM k GROUP BY class"
ORACLE["reconcile_columns"] = _PAIRED + " UNION ALL ".join(
    f"SELECT {q(c)} AS column_name, COUNT(*) AS paired, COUNT(*) FILTER (WHERE l_{c} IS DISTINCT FROM r_{c}) AS different, "
    f"COUNT(*) FILTER (WHERE l_{c} IS NULL AND r_{c} IS NOT NULL) AS left_null, COUNT(*) FILTER (WHERE r_{c} IS NULL AND l_{c} IS NOT NULL) AS right_null "
    "FROM k WHERE class IN ('equal', 'different')"
    for c in _COMPARED
)

ORACLE["severity_lookup"] = f"""
WITH {FINES_RAW_CTE}, rules AS (
  SELECT upper(CAST(160 + p_partkey % 90 AS VARCHAR) || CASE WHEN p_size % 5 = 0 THEN ', i' WHEN p_size % 5 = 1 THEN ', II' ELSE '' END) AS prefixo,
    min(CASE CAST((p_partkey + p_size) % 4 AS INT) WHEN 0 THEN 'Gravíssima' WHEN 1 THEN 'Grave' WHEN 2 THEN 'Média' ELSE 'Leve' END) AS gravidade
  FROM part WHERE p_partkey % 90 < 70 AND p_size % 7 = 0 GROUP BY 1
), texts AS (SELECT enquadramento_infracao AS t, COUNT(*) AS linhas FROM fines_raw GROUP BY 1), hits AS (
  SELECT t, arg_max(gravidade, length(prefixo)) AS gravidade FROM texts JOIN rules ON starts_with(upper(trim(t)), prefixo)
    AND NOT regexp_matches(substr(upper(trim(t)), length(prefixo) + 1, 1), '[\\p{{L}}\\p{{N}}]') GROUP BY t
)
SELECT t AS enquadramento_infracao, coalesce(gravidade, 'Não classificada') AS gravidade, linhas FROM texts LEFT JOIN hits USING (t)
"""

_REASONS = [
    ("sem_numero", "numero_auto IS NULL"),
    ("data_invalida", f"(CASE WHEN regexp_full_match(data_infracao, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST(data_infracao AS DATE) END) IS NULL"),
    ("excesso_verificado_fora_do_limite", f"NOT ({_guarded_dec('excesso_verificado')} BETWEEN 0 AND 150)"),
    ("hora_infracao_fora_do_limite", f"NOT (CASE WHEN regexp_full_match(hora_infracao, {_NUM_INT}) THEN coalesce(TRY_CAST(hora_infracao AS INTEGER), 0) ELSE 0 END BETWEEN 0 AND 2359)"),
]
_WHY = "concat_ws(',', " + ", ".join(f"CASE WHEN coalesce({cond}, FALSE) THEN {q(k)} END" for k, cond in _REASONS) + ")"
_ROUTED = f"routed AS (SELECT *, {_WHY} AS motivos FROM (SELECT DISTINCT * FROM fines_raw))"
ORACLE["rejects_sql"] = with_raw(f"SELECT * FROM (SELECT *, {_WHY} AS motivos FROM (SELECT DISTINCT * FROM fines_raw)) WHERE motivos <> ''")
ORACLE["clean_sane_sql"] = with_prepared("SELECT * FROM prepared WHERE excesso_verificado BETWEEN 0 AND 150 AND (hora_infracao IS NULL OR hora_infracao BETWEEN 0 AND 2359)")
ORACLE["routing_totals"] = f"WITH {FINES_RAW_CTE}, {_ROUTED} " + " UNION ALL ".join(
    f"SELECT {q(k)} AS total, COUNT(*) FILTER (WHERE {cond}) AS linhas FROM routed"
    for k, cond in [("entrada", "TRUE"), ("limpas", "motivos = ''"), ("rejeitadas", "motivos <> ''"), *[(k, f"coalesce({c}, FALSE)") for k, c in _REASONS]]
)

_LOADED = "CASE WHEN numero_auto IS NULL OR CAST(substr(numero_auto, 2, 8) AS INTEGER) % 2 = 0 THEN 2023 ELSE 2024 END"
ORACLE["rows_per_load"] = with_raw(f"SELECT CAST({_LOADED} AS INTEGER) AS ano, COUNT(*) AS linhas FROM fines_raw GROUP BY 1")
ORACLE["totals_per_load"] = ORACLE["rows_per_load"]
ORACLE["append_twice"] = with_raw(f"SELECT CAST({_LOADED} AS INTEGER) AS ano, COUNT(*) AS linhas, CAST(1 AS BIGINT) AS cargas FROM fines_raw GROUP BY 1")

_LOC = ["uf_infracao", "municipio", "br_infracao", "km_infracao", "regiao_infracao", "sentido_trafego"]
ORACLE["dim_location_appended"] = with_prepared(f"""
SELECT row_number() OVER (ORDER BY primeira, {', '.join(f'{c} NULLS LAST' for c in _LOC)}) AS id_localizacao_sk, uf_infracao, br_infracao, km_infracao, municipio, regiao_infracao, sentido_trafego
FROM (SELECT {', '.join(_LOC)}, min(CASE WHEN ano < 2024 THEN 0 ELSE 1 END) AS primeira FROM prepared GROUP BY {', '.join(_LOC)})""")
ORACLE["fact_appended"] = with_prepared(
    "SELECT ano, uf_infracao, codigo_infracao, descricao_tipo_veiculo, COUNT(*) AS autos, CAST(SUM(qtd_infracoes) AS BIGINT) AS infracoes FROM prepared GROUP BY 1, 2, 3, 4"
)
ORACLE["report_bucketed"] = with_star(
    "SELECT descricao_especie_veiculo, descricao_tipo_veiculo, descricao_marca_veiculo, COUNT(*) AS autos, CAST(SUM(qtd_infracoes) AS BIGINT) AS infracoes "
    "FROM fato_multa JOIN dim_infrator USING (id_infrator_sk) GROUP BY 1, 2, 3"
)
