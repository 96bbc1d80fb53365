"""The fixed values, spelled out: the oracle's SQL renders the same lists, so a slip in one of them would show nowhere else."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.functions import calendar as cal
from starmart.functions import decode as dec
from starmart.functions import rounding as R
from starmart.functions import vocab as V
from starmart.operators.profile import term_counts


def apply(spark, expr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_states_of_each_region(spark):
    want = {
        "AC": "Norte", "AM": "Norte", "AP": "Norte", "PA": "Norte", "RO": "Norte", "RR": "Norte", "TO": "Norte",
        "AL": "Nordeste", "BA": "Nordeste", "CE": "Nordeste", "MA": "Nordeste", "PB": "Nordeste", "PE": "Nordeste", "PI": "Nordeste", "RN": "Nordeste", "SE": "Nordeste",
        "DF": "Centro-Oeste", "GO": "Centro-Oeste", "MS": "Centro-Oeste", "MT": "Centro-Oeste",
        "ES": "Sudeste", "MG": "Sudeste", "RJ": "Sudeste", "SP": "Sudeste", "PR": "Sul", "RS": "Sul", "SC": "Sul", "EX": "NÃO INFORMADO", "sp": "NÃO INFORMADO",
    }
    assert apply(spark, dec.region_for("c", "sql"), want) == list(want.values())
    assert apply(spark, dec.region_for("c", "frame"), [" sp ", "EX"]) == ["Sudeste", "Não informado"]
    assert apply(spark, dec.region("c", "Não identificado"), ["SP", "XX"]) == ["Sudeste", "Não identificado"]


def test_codes(spark):
    assert apply(spark, dec.doc_type("c", "sql"), ["AI", " ait", "ANI", " ", "X"]) == [
        "Auto de Infração", "Auto de Infração de Trânsito", "Aviso de Notificação de Infração", "NÃO INFORMADO", "X"]
    assert apply(spark, dec.direction("c", "sql"), ["C", " d ", "X", None]) == ["Crescente", "Decrescente", "NÃO INFORMADO", "NÃO INFORMADO"]
    assert apply(spark, dec.direction("c", "frame"), ["C", "X"]) == ["Crescente", "Não informado"]
    assert apply(spark, dec.foreign_flag("c"), ["S", "AR", "BO", "CL", "GY", "MX", "PY", "UY", "VE", "N", "BR", "/", None]) == ["S"] * 9 + ["N", "N", "N/I", "N/I"]
    assert apply(spark, dec.plate_state("c", "sql"), ["SP", "EX", "N/I", "/", "-1", "'-1", "", "2F", "pe"]) == ["SP", "EX", "N/I", "N/I", "N/I", "N/I", "N/I", "EX", "N/I"]


def test_missing_terms(spark):
    none = "NÃO INFORMADO"
    missing = ["'-1", "-1", "NA", "NAO INFORMADO", "NÃO ENCONTRADO", "NÃO INFORMADO", " não encontrado "]
    assert apply(spark, dec.vehicle_type("c", "sql"), [*missing, "Carro"]) == [none] * 7 + ["CARRO"]
    assert apply(spark, dec.species("c", "sql"), ["N/I", "NA", " ", "tracao", "COLECAO", "competicao", "outra"]) == [none, none, "Não Informado", "TRAÇÃO", "COLEÇÃO", "COMPETIÇÃO", "OUTRA"]
    assert apply(spark, dec.species("c", "frame"), ["passageiro", "CARGA", "ESPECIAL", "MISTO", "CORRIDA", "COMPETIÇÃO", "TRACAO", "outra"]) == [
        "PASSAGEIRO", "CARGA", "ESPECIAL", "MISTO", "CORRIDA", "COMPETIÇÃO", "TRAÇÃO", none]
    df = spark.createDataFrame([(x,) for x in (" na", "-1", "'-1", "NÃO ENCONTRADO", "FIAT")], "c string")
    assert {r["value"]: r["n"] for r in term_counts(df, "c", V.INSPECTED_TERMS).collect()} == {"NA": 1, "-1": 1, "NÃO ENCONTRADO": 1}


def test_calendar(spark):
    days = ["2022-01-01", "2022-03-01", "2022-04-15", "2022-04-17", "2022-06-16", "2023-02-21", "2023-04-07", "2023-04-09", "2023-06-08", "2024-02-13", "2024-03-29",
            "2024-03-31", "2024-05-30", "2023-04-21", "2023-05-01", "2023-09-07", "2023-10-12", "2023-11-02", "2023-11-15", "2023-12-25", "2023-12-24", "2024-02-14"]
    df = spark.createDataFrame([(i, dt.date.fromisoformat(d)) for i, d in enumerate(days)], "i int, c date").orderBy("i")
    for kind in ("listed", "computed"):
        assert [r[0] for r in df.select(cal.is_holiday("c", kind)).collect()] == [True] * 20 + [False, False]
    week = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 8)], "c date").orderBy("c")
    assert [r[0] for r in week.select(cal.weekday_name("c")).collect()] == ["Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado", "Domingo"]


def test_report_constants():
    assert (V.EXCESS_RANGE, V.OUTLIER_EXCESS, V.MIN_GROUP_ROWS, V.HOUR_RANGE) == ((0, 150), 200, 100, (0, 2359))
    assert V.REPORT_EXCLUDED_STATES == ["N/I", "EX"] and V.STACK_ORDER == ["Norte", "Nordeste", "Centro-Oeste", "Sul", "Sudeste"]
    assert V.REPORT_EXCLUDED_LABELS == ["-1", "Não informado", "N/I", "NÃO INFORMADO"]
    assert V.REGION_COLOURS == {"Norte": "#2196F3", "Nordeste": "#FF9800", "Centro-Oeste": "#9C27B0", "Sudeste": "#F44336", "Sul": "#4CAF50"}


@pytest.mark.parametrize("part,whole,want", [(1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (1, 1600, 0.06), (0, 5, 0.0), (5, 0, None), (-1, 8, -12.5)])
def test_rounding_half_away_from_zero(spark, part, whole, want):
    got = spark.range(1).select(R.round_percent(F.lit(part).cast("long"), F.lit(whole).cast("long"), 2)).first()[0]
    assert (None if got is None else float(got)) == want
