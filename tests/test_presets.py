"""The documented differences between the two rule sets, on one literal raw table."""

from decimal import Decimal

from starmart.plans.prepare import normalize
from starmart.schemas import RAW_COLUMNS


def raw_rows(spark, rows):
    base = {c: "" for c in RAW_COLUMNS}
    out = []
    for r in rows:
        d = dict(base)
        d.update(r)
        out.append(tuple(d[c] for c in RAW_COLUMNS))
    return spark.createDataFrame(out, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def test_rule_set_differences(spark):
    common = {"numero_auto": "A1", "data_infracao": "2023-05-02", "uf_infracao": "SP", "km_infracao": "12,5",
              "excesso_verificado": "5,5", "hora_infracao": "x", "descricao_especie_veiculo": "OFICIAL",
              "municipio": "", "sentido_trafego": "q"}
    raw = raw_rows(spark, [common, common, {**common, "numero_auto": "A2", "uf_infracao": ""}])
    sql = {r["numero_auto"]: r for r in normalize(raw, "sql").collect()}
    frame = normalize(raw, "frame").collect()
    # whole-row duplicates: removed by the SQL rules only
    assert len(sql) == 2 and len(frame) == 3
    f = {r["numero_auto"]: r for r in frame}
    a_sql, a_fr = sql["A1"], f["A1"]
    assert a_sql["km_infracao"] == 0 and a_fr["km_infracao"] == 12.5
    assert a_sql["excesso_verificado"] == Decimal("5.50") and a_fr["excesso_verificado"] == 5.5
    assert a_sql["hora_infracao"] == 0 and a_fr["hora_infracao"] == "x"
    assert a_sql["descricao_especie_veiculo"] == "OFICIAL" and a_fr["descricao_especie_veiculo"] == "NÃO INFORMADO"
    assert a_sql["municipio"] == "" and a_fr["municipio"] == "NÃO INFORMADO"
    assert a_sql["sentido_trafego"] == "NÃO INFORMADO" and a_fr["sentido_trafego"] == "Não informado"
    assert sql["A2"]["regiao_infracao"] == "NÃO INFORMADO" and f["A2"]["regiao_infracao"] == "Não informado"
    assert "is_feriado" in normalize(raw, "frame").columns and "is_feriado" not in normalize(raw, "sql").columns


def test_rows_without_key_or_valid_date_are_dropped(spark):
    raw = raw_rows(spark, [
        {"numero_auto": None, "data_infracao": "2023-01-01"},
        {"numero_auto": "B1", "data_infracao": "31/12/2023"},
        {"numero_auto": "B2", "data_infracao": "2022-13-45"},
        {"numero_auto": "B3", "data_infracao": "2024-02-29"},
        {"numero_auto": "", "data_infracao": "2024-02-28"},
    ])
    for rules in ("sql", "frame"):
        kept = sorted(r["numero_auto"] for r in normalize(raw, rules).select("numero_auto").collect())
        assert kept == ["", "B3"], rules  # a blank auto number is not NULL and is kept, as in the source


def test_missing_column_under_frame_rules(spark):
    raw = raw_rows(spark, [{"numero_auto": "C1", "data_infracao": "2023-03-03"}]).drop("descricao_marca_veiculo", "assinatura_auto")
    r = normalize(raw, "frame").first()
    assert r["descricao_marca_veiculo"] == "NÃO INFORMADO" and r["assinatura_auto"] == "NÃO INFORMADO"
    assert normalize(raw, "sql").first()["descricao_marca_veiculo"] == "NÃO INFORMADO"
