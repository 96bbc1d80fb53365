"""One literal row per rule branch, both rule sets."""

from pyspark.sql import functions as F

from starmart.functions import calendar as cal
from starmart.functions import decode as dec
from starmart.functions import parse as P
from starmart.functions.rounding import round_ratio


def run(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_region(spark):
    vals = ["SP", "AM", "BA", "DF", "RS", " sp", "", None, "XX"]
    assert run(spark, vals, lambda c: dec.region_for(c, "sql")) == [
        "Sudeste", "Norte", "Nordeste", "Centro-Oeste", "Sul", "NÃO INFORMADO", "NÃO INFORMADO", "NÃO INFORMADO", "NÃO INFORMADO"]
    assert run(spark, vals, lambda c: dec.region_for(c, "frame"))[5:] == ["Sudeste", "Não informado", "Não informado", "Não informado"]


def test_direction(spark):
    vals = ["C", " d ", "X", "", None, "d\t"]
    assert run(spark, vals, lambda c: dec.direction(c, "sql")) == [
        "Crescente", "Decrescente", "NÃO INFORMADO", "NÃO INFORMADO", "NÃO INFORMADO", "NÃO INFORMADO"]
    assert run(spark, vals, lambda c: dec.direction(c, "frame")) == [
        "Crescente", "Decrescente", "Não informado", "Não informado", "Não informado", "Decrescente"]


def test_doc_type(spark):
    vals = ["AI", " ait ", "ANI", "", "N/I", None, "x"]
    assert run(spark, vals, lambda c: dec.doc_type(c, "sql")) == [
        "Auto de Infração", "Auto de Infração de Trânsito", "Aviso de Notificação de Infração", "NÃO INFORMADO", "N/I", "NÃO INFORMADO", "x"]
    assert run(spark, vals, lambda c: dec.doc_type(c, "frame"))[3:] == ["NÃO INFORMADO", "N/I", "NÃO INFORMADO", "X"]


def test_species(spark):
    vals = ["Passageiro", "TRACAO", "colecao", "Competicao", "-1", "N/I", "", "OFICIAL", "'-1", "na"]
    assert run(spark, vals, lambda c: dec.species(c, "sql")) == [
        "PASSAGEIRO", "TRAÇÃO", "COLEÇÃO", "COMPETIÇÃO", "NÃO INFORMADO", "NÃO INFORMADO", "Não Informado", "OFICIAL",
        "NÃO INFORMADO", "NÃO INFORMADO"]
    assert run(spark, vals, lambda c: dec.species(c, "frame")) == [
        "PASSAGEIRO", "TRAÇÃO", "COLEÇÃO", "NÃO INFORMADO", "NÃO INFORMADO", "NÃO INFORMADO", "NÃO INFORMADO", "NÃO INFORMADO",
        "NÃO INFORMADO", "NÃO INFORMADO"]


def test_type_and_make(spark):
    vals = ["Não encontrado", "automovel", "NAO INFORMADO", "-1", "", "Não informado"]
    assert run(spark, vals, lambda c: dec.vehicle_type(c, "sql")) == [
        "NÃO INFORMADO", "AUTOMOVEL", "NÃO INFORMADO", "NÃO INFORMADO", "", "NÃO INFORMADO"]
    assert run(spark, vals, lambda c: dec.make(c, "frame"))[-2:] == ["", "NÃO INFORMADO"]


def test_plate(spark):
    vals = ["SP", "pe", "-1", "'-1", "1-", "/", "2F", "EX", "N/I", "", "ABC", None]
    assert run(spark, vals, lambda c: dec.plate_state(c, "sql")) == [
        "SP", "N/I", "N/I", "N/I", "EX", "N/I", "EX", "EX", "N/I", "N/I", "N/I", "N/I"]
    assert run(spark, vals, lambda c: dec.plate_state(c, "frame")) == [
        "SP", "PE", "N/I", "N/I", "N/I", "N/I", "EX", "EX", "N/I", "N/I", "N/I", "N/I"]


def test_foreign(spark):
    vals = ["S", "N", "BR", "AR", "VE", "/", "99", "", None, "s"]
    assert run(spark, vals, dec.foreign_flag) == ["S", "N", "N", "S", "S", "N/I", "N/I", "N/I", "N/I", "N/I"]


def test_numbers(spark):
    km = ["12", "12,5", "12.5", "-3", "km?", "", None, " 7 "]
    assert run(spark, km, lambda c: P.km(c, "sql")) == [12, 0, 0, -3, 0, 0, 0, 0]
    assert run(spark, km, lambda c: P.km(c, "frame")) == [12.0, 12.5, 12.5, 0.0, 0.0, 0.0, 0.0, 7.0]
    ints = ["5", "5.0", "x", "", None, "99999999999", "1e3", "-2"]
    assert run(spark, ints, lambda c: P.guarded_int(c, 1)) == [5, 1, 1, 1, 1, 1, 1, -2]
    assert run(spark, ints, lambda c: P.frame_int(c, 1)) == [5, 5, 1, 1, 1, 99999999999, 1000, -2]
    hours = [None, "x", "-1", "2400", "1330"]
    assert run(spark, hours, P.guarded_hour) == [None, 0, -1, 2400, 1330]


def test_decimal_comma(spark):
    from decimal import Decimal

    vals = ["91,00", "1.234,56", "n/d", "", None, "-2,5", ".5", "1e3", "123456789,1", "5,555"]
    assert run(spark, vals, lambda c: P.decimal_comma(c, "sql")) == [
        Decimal("91.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("-2.50"), Decimal("0.50"),
        Decimal("0.00"), Decimal("0.00"), Decimal("5.56")]
    assert run(spark, vals, lambda c: P.decimal_comma(c, "frame")) == [91.0, 0.0, 0.0, 0.0, 0.0, -2.5, 0.5, 1000.0, 123456789.1, 5.555]


def test_dates(spark):
    vals = ["2024-03-31", "31/12/2023", "2022-13-45", "", None, "2024-1-5", "2024-02-30"]
    got = run(spark, vals, P.iso_date)
    assert str(got[0]) == "2024-03-31" and all(g is None for g in got[1:])
    mixed = run(spark, vals, P.mixed_date)
    assert str(mixed[1]) == "2023-12-31"


def test_calendar(spark):
    vals = ["2024-03-31", "2024-03-29", "2023-02-21", "2022-06-16", "2024-12-25", "2024-04-01", "2030-04-21"]
    df = spark.createDataFrame([(v,) for v in vals], "s string").select(F.to_date("s").alias("d"))
    listed = [r[0] for r in df.select(cal.is_holiday("d", "listed")).collect()]
    assert listed == [True, True, True, True, True, False, True]
    easter = [str(r[0]) for r in spark.createDataFrame([(y,) for y in (2022, 2023, 2024, 2025)], "y int")
              .select(cal.easter_sunday(F.col("y"))).collect()]
    assert easter == ["2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20"]
    wd = [r[0] for r in df.select(cal.weekday_name("d")).collect()]
    assert wd[0] == "Domingo" and wd[5] == "Segunda-feira"


def test_round_ratio_is_exact(spark):
    from decimal import Decimal

    rows = [(1, 8, 2), (-1, 8, 2), (1005, 100000, 2), (2, 3, 2), (5, 0, 2), (1, 20, 1), (-1, 20, 1)]
    df = spark.createDataFrame(rows, "n long, d long, s int")
    got = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("0.01"), Decimal("0.67"), None, Decimal("0.05"), Decimal("-0.05")]


def test_holiday_calendar_and_changed_values(spark):
    from starmart.operators.profile import changed_values

    cal_df = cal.holiday_calendar(spark, [2022, 2023, 2024])
    assert cal_df.count() == 3 * 8 + 12
    assert cal.holiday_calendar(spark, [2025], "computed").filter(F.col("data") == F.lit("2025-04-18").cast("date")).count() == 1
    df = spark.createDataFrame([("c",), ("C",), ("x",), ("c",)], "s string")
    got = {(r["before"], r["after"]): r["n"] for r in changed_values(df.withColumn("t", dec.direction("s", "sql")), "s", "t").collect()}
    assert got == {("c", "Crescente"): 2, ("C", "Crescente"): 1, ("x", "NÃO INFORMADO"): 1}


def test_labels_and_formats(spark):
    from starmart.functions import labels as L
    from starmart.functions import vocab as V

    df = spark.createDataFrame([(1234567, "Sudeste", 74550, "Transitar em velocidade superior à máxima permitida em até 20%", 12.34)],
                               "n long, r string, code int, d string, v double")
    r = df.select(
        L.thousands("n").alias("t"), L.dot_thousands("n").alias("dt"), L.millions_label("n").alias("m"),
        L.signed_percent("v").alias("p"), L.signed_percent(F.lit(-4.0)).alias("pn"), L.signed_percent(F.lit(0.0)).alias("p0"),
        L.code_label("code", "d").alias("lab"), L.colour("r", V.REGION_COLOURS).alias("c"),
        L.colour(F.lit("X"), V.REGION_COLOURS).alias("c2"), L.pair_label(F.lit("A"), F.lit("B")).alias("pl"),
    ).first()
    assert (r["t"], r["dt"], r["m"]) == ("1,234,567", "1.234.567", "1.2M")
    assert (r["p"], r["pn"], r["p0"]) == ("+12.3%", "-4.0%", "0.0%")
    text = "Transitar em velocidade superior à máxima permitida em até 20%"
    assert r["lab"] == "[74550] " + text[:45] + "..."
    assert (r["c"], r["c2"], r["pl"]) == ("#F44336", "#888", "A / B")
