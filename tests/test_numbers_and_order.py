"""Numbers outside the usual ranges, means against a plain formula, published order, years from the data, pruning."""

import math

import duckdb
import pytest

from starmart.catalog import registry, star_for
from starmart.functions import parse as P
from starmart.functions import vocab as V
from starmart.oracle_sql import Q1_G, _star_with
from starmart.plans import reports as R
from starmart.plans.prepare import normalize
from starmart.plans.star import build_star, star_from_tables, write_star
from starmart.sources.tables import TABLES
from test_presets import raw_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_frame_integers_keep_64_bits(spark):
    values = ["3000000000", "5.0", "1e3", "-7.9", "1e19", "x", "", None, "9007199254740993"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(P.frame_int("v", 1).alias("n"))
    assert [r.n for r in df.collect()] == [3000000000, 5, 1000, -7, 1, 1, 1, 1, 9007199254740992]


def test_one_huge_number_does_not_abort_a_report(spark):
    base = {"numero_auto": "A", "data_infracao": "2023-05-02", "uf_infracao": "SP", "descricao_abreviada_infracao": "d"}
    rows = [{**base, "codigo_infracao": "1", "excesso_verificado": e} for e in ("1e300", "5,5")]
    rows += [{**base, "codigo_infracao": "2", "excesso_verificado": e} for e in ("1e400", "2")]
    rows += [{**base, "codigo_infracao": "3", "excesso_verificado": e} for e in ("5,5", "6,5", "0")]
    star = build_star(normalize(raw_rows(spark, rows), "frame"), "frame", materialize_tables=False)
    got = {r.codigo_infracao: r for r in R.q4(star).collect()}
    assert got[1].media_excesso_kmh is None and got[1].maior_excesso_kmh == 1e300
    assert got[2].media_excesso_kmh is None and math.isinf(got[2].maior_excesso_kmh)
    assert float(got[3].media_excesso_kmh) == 6.0


def test_replaced_numbers_are_counted(spark):
    got = {(r.rules, r.field): r.n for r in registry()["profile_replaced"](spark, SF).collect()}
    assert got["sql", "codigo_infracao"] > 0 and got["frame", "codigo_infracao"] == 0


def test_years_come_from_the_data(spark):
    wide = star_for(spark, SF, "sql", view="fines_wide")
    assert R.years_of(R.q1_table(wide)) == list(range(2020, 2027))
    assert R.q1b(wide).columns == ["regiao", *map(str, range(2020, 2027)), "var_20_26_pct"]


@pytest.mark.parametrize("name", sorted(R.ORDERS))
def test_reports_come_in_their_published_order(spark, name):
    rows = R.REPORTS[name](star_for(spark, SF)).collect()
    numbered = registry()[f"{name}_ordered"](spark, SF).orderBy("ordem").drop("ordem").collect()
    assert rows == numbered and (len(rows) > 1 or name == "report_q2")  # no profile of this small table has 100 rows


def test_means_against_a_plain_average(spark, duck):
    sql = "SELECT i.codigo_infracao, avg(CASE WHEN f.excesso_verificado <> 0 THEN f.excesso_verificado END) m FROM fato_multa f JOIN dim_infracao i USING (id_infracao_sk) GROUP BY 1"
    want = dict(duck.execute(_star_with(Q1_G, sql)).fetchall())
    got = {r.codigo_infracao: r.media_excesso_kmh for r in R.q4_all(star_for(spark, SF)).collect()}
    assert set(got) == set(want)
    assert all((got[k] is None) == (want[k] is None) and (got[k] is None or abs(float(got[k]) - float(want[k])) <= 0.005 + 1e-9) for k in got)


def test_one_year_reads_one_partition(spark):
    plan = R.q6(star_for(spark, SF), 2023)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_fato" in plan and "= 2023" in plan


def test_outliers_join_few_rows_and_keep_ties(spark):
    base = {"data_infracao": "2023-05-02", "codigo_infracao": "1"}
    rows = [{**base, "numero_auto": f"A{i}", "excesso_verificado": str(300 + i % 4), "descricao_especie_veiculo": ["CARGA", "MISTO"][i % 2], "descricao_tipo_veiculo": f"T{i % 3}"} for i in range(40)]
    star = build_star(normalize(raw_rows(spark, rows), "sql"), "sql", materialize_tables=False)
    got = [(float(r.excesso_kmh), r.descricao_especie_veiculo, r.descricao_tipo_veiculo) for r in R.q3(star, k=13).collect()]
    want = sorted(((-(300.0 + i % 4), ["CARGA", "MISTO"][i % 2], f"T{i % 3}") for i in range(40)))[:13]
    assert got == [(-a, b, c) for a, b, c in want]


def test_a_star_can_be_dropped_and_reopened(spark, tmp_path):
    star = build_star(normalize(raw_rows(spark, [{"numero_auto": "A", "data_infracao": "2023-05-02"}]), "sql"), "sql")
    paths = write_star(star, str(tmp_path))
    star.drop()
    again = star_from_tables(spark, paths)
    assert again.fato_multa.count() == 1 and again.rows["dim_tempo"] == 1 and 0 < again.sizes["dim_infrator"] < 10_000


def test_word_lists_are_the_published_ones():
    assert V.MISSING_TERMS == ["'-1", "-1", "NA", "NAO INFORMADO", "NÃO ENCONTRADO", "NÃO INFORMADO"]
    assert V.INSPECTED_TERMS == ["-1", "NA", "NAO INFORMADO", "NÃO ENCONTRADO", "NÃO INFORMADO"]
    assert V.SPECIES_KEPT == ["PASSAGEIRO", "CARGA", "ESPECIAL", "MISTO", "CORRIDA", "COMPETIÇÃO"]
    assert V.FOREIGN_COUNTRIES == ["AR", "BO", "CL", "GY", "MX", "PY", "UY", "VE"]
    assert V.PLATE_JUNK == ["/", "-1", "'-1", ""]
    assert V.DOC_TYPES == {"AI": "Auto de Infração", "AIT": "Auto de Infração de Trânsito", "ANI": "Aviso de Notificação de Infração"}
    assert V.DIRECTIONS == {"C": "Crescente", "D": "Decrescente"}
    assert V.FIXED_HOLIDAYS == [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
    assert V.REPORT_EXCLUDED_STATES == ["N/I", "EX"] and V.REPORT_EXCLUDED_LABELS == ["-1", "Não informado", "N/I", "NÃO INFORMADO"]
    assert (V.EXCESS_RANGE, V.OUTLIER_EXCESS, V.MIN_GROUP_ROWS, V.HOUR_RANGE, V.LABEL_PREFIX_CHARS) == ((0, 150), 200, 100, (0, 2359), 45)
    assert {k: len(v) for k, v in V.REGIONS.items()} == {"Norte": 7, "Nordeste": 9, "Centro-Oeste": 4, "Sudeste": 4, "Sul": 3} and len(V.STATES) == 27


def test_profile_sections_per_load(spark):
    rows = registry()["profile_report"](spark, SF).collect()
    sections = {r.section for r in rows}
    assert sections == {"nulls", "dates", "hours", "duplicates", "describe", "values", "sample"} and {r.ano_carga for r in rows} == {2022, 2023, 2024}
    assert max(int(r.metric) for r in rows if r.section == "sample") == 50
