"""Files with quotes, backslashes, blank first lines, malformed rows; totals per load."""

from starmart.plans import generic as G
from starmart.sources.csv import MALFORMED, malformed_per_file, read_raw, write_csv_batches

SF = "/root/testdata/sf0.001"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_backslash_and_doubled_quotes(spark, tmp_path):
    put(tmp_path / "a.csv", 'Número do Auto;Município;UF Infração\nA1;"C:\\";SP\nA2;"S ""X"" Y";RJ\nA3;"a;b";MG\n')
    got = {r.numero_auto: (r.municipio, r.uf_infracao) for r in read_raw(spark, str(tmp_path / "*.csv")).collect()}
    assert got == {"A1": ("C:\\", "SP"), "A2": ('S "X" Y', "RJ"), "A3": ("a;b", "MG")}


def test_blank_first_lines_do_not_swap_columns(spark, tmp_path):
    put(tmp_path / "a.csv", "\nNúmero do Auto;Qtd Infrações\nA1;1\n")
    put(tmp_path / "b.csv", "\n \nQtd Infrações;Número do Auto\n2;A2\n")
    got = sorted((r.numero_auto, r.qtd_infracoes) for r in read_raw(spark, str(tmp_path / "*.csv")).collect())
    assert got == [("A1", "1"), ("A2", "2")]


def test_malformed_rows_are_kept_and_counted(spark, tmp_path):
    put(tmp_path / "a.csv", "Número do Auto;UF Infração\nA1;SP\nA2;SP;x\nA3\n")
    put(tmp_path / "b.csv", "Número do Auto;UF Infração\nB1;SP\n")
    raw = read_raw(spark, str(tmp_path / "*.csv"), with_malformed=True)
    got = {r.numero_auto: r[MALFORMED] for r in raw.collect()}
    assert got == {"A1": None, "A2": "A2;SP;x", "A3": "A3", "B1": None}
    counts = {r.source_file.rsplit("/", 1)[-1]: (r.rows, r.malformed) for r in malformed_per_file(raw).collect()}
    assert counts == {"a.csv": (3, 2), "b.csv": (1, 0)}


def test_written_values_come_back(spark, tmp_path):
    values = ["C:\\", 'S "X" Y', "a;b", '"', '\\"\\;', "  ", "é", "plain", '""']
    df = spark.createDataFrame([(f"A{i}", v) for i, v in enumerate(values)], "numero_auto string, municipio string")
    write_csv_batches(df, str(tmp_path / "out"), ["Número do Auto", "Município"])
    got = {r.numero_auto: r.municipio for r in read_raw(spark, str(tmp_path / "out/*.csv")).collect()}
    assert got == {f"A{i}": v for i, v in enumerate(values)}


def test_overlong_header_is_an_error(spark, tmp_path):
    import pytest

    put(tmp_path / "a.csv", "x" * 100_001 + "\n1\n")
    with pytest.raises(ValueError, match="header longer"):
        read_raw(spark, str(tmp_path / "*.csv"))


def test_rows_per_load_add_up(spark):
    got = {r.ano: r.linhas for r in G.rows_per_load(spark, SF).collect()}
    assert set(got) == {2023, 2024} and sum(got.values()) == G.landing(spark, SF).count()
