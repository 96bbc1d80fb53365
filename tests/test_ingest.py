"""CSV ingest: encodings, header order, corrupted and unaccented headers, missing/extra columns, blank rows."""

import os

from pyspark.sql import functions as F

from starmart.plans.prepare import normalize
from starmart.schemas import RAW_COLUMNS, RAW_COLUMNS_AND_HEADERS
from starmart.sources.csv import read_raw, resolve_header, sniff_files, source_year

HEADERS = [h for _, h in RAW_COLUMNS_AND_HEADERS]


def _row(i, date="2022-05-10"):
    vals = {c: f"{c[:3]}{i}" for c in RAW_COLUMNS}
    vals.update(numero_auto=f"A{i}", data_infracao=date, uf_infracao="SP", km_infracao="12", municipio="Município Ç",
                codigo_infracao="74550", qtd_infracoes="1", excesso_verificado="5,5", medicao_considerada="91,00")
    return vals


def _write(path, headers, rows, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(";".join(headers) + "\n")
        for r in rows:
            f.write(";".join(r) + "\n")


def _unaccent(h):
    import unicodedata

    return "".join(ch for ch in unicodedata.normalize("NFD", h) if not unicodedata.combining(ch))


def _corrupt(h):
    return "".join("�" if ord(ch) > 127 else ch for ch in h)


def make_files(base):
    cols = RAW_COLUMNS
    # a: UTF-8, canonical accented header
    _write(f"{base}/2022/a.csv", HEADERS, [[_row(i)[c] for c in cols] for i in range(3)])
    # b: Latin-1, reversed column order
    rev = list(reversed(range(len(cols))))
    _write(f"{base}/2022/b.csv", [HEADERS[i] for i in rev], [[_row(10 + i)[cols[j]] for j in rev] for i in range(2)], "latin-1")
    # c: header with replacement characters where accents were
    rows_c = [[_row(20)[c] for c in cols]]
    rows_c[0][cols.index("municipio")] = ""  # a blank field stays ''
    _write(f"{base}/2022/c.csv", [_corrupt(h) for h in HEADERS], rows_c)
    # d: unaccented header, one column missing (medicao_infracao), one extra
    keep = [i for i, c in enumerate(cols) if c != "medicao_infracao"]
    _write(f"{base}/2023/d.csv", [_unaccent(HEADERS[i]) for i in keep] + ["Coluna Extra"],
           [[_row(30, "2023-01-02")[cols[i]] for i in keep] + ["zzz"]])
    # e: rows of separators only
    _write(f"{base}/2024/e.csv", HEADERS, [[""] * len(cols) for _ in range(2)])


def test_resolve_header_variants():
    assert resolve_header("Número do Auto") == "numero_auto"
    assert resolve_header("  NUMERO DO AUTO ") == "numero_auto"
    assert resolve_header("munic�pio") == "municipio"
    assert resolve_header("data da infra��o (dd/mm/aaaa)") == "data_infracao"
    assert resolve_header("descri��o especie ve�culo") == "descricao_especie_veiculo"
    assert resolve_header("descrição modelo veiculo") == "descricao_modelo_veiculo"
    assert resolve_header("MunicÃ­pio") == "municipio"  # UTF-8 read as Latin-1
    assert resolve_header("Coluna Extra") is None
    assert all(resolve_header(h) == c for c, h in RAW_COLUMNS_AND_HEADERS)


def test_sniff_encodings(spark, tmp_path):
    make_files(str(tmp_path))
    rows = {os.path.basename(r["file_path"]): r for r in sniff_files(spark, str(tmp_path) + "/*/*.csv").collect()}
    assert rows["a.csv"]["valid_utf8"] and not rows["b.csv"]["valid_utf8"]
    assert rows["c.csv"]["header_has_replacement"]
    assert rows["a.csv"]["header_line"].startswith("Número do Auto;")


def test_read_raw_union(spark, tmp_path):
    make_files(str(tmp_path))
    raw = read_raw(spark, str(tmp_path) + "/*/*.csv")
    assert raw.columns == RAW_COLUMNS + ["source_file"]
    got = {r["numero_auto"]: r for r in raw.collect()}
    assert len(raw.collect()) == 3 + 2 + 1 + 1 + 2
    # latin-1 file decoded, columns matched by name despite reversed order
    assert got["A10"]["municipio"] == "Município Ç" and got["A10"]["uf_infracao"] == "SP"
    assert got["A10"]["km_infracao"] == "12"
    # corrupted header matched; blank field kept as ''
    assert got["A20"]["municipio"] == "" and got["A20"]["data_infracao"] == "2022-05-10"
    # unaccented header; missing column is NULL; extra column dropped
    assert got["A30"]["medicao_infracao"] is None and got["A30"]["data_infracao"] == "2023-01-02"
    assert got["A0"]["medicao_infracao"] == "med0"
    years = {r["y"] for r in raw.select(source_year().alias("y")).collect()}
    assert years == {2022, 2023, 2024}


def test_blank_rows_dropped_by_date_rule(spark, tmp_path):
    make_files(str(tmp_path))
    raw = read_raw(spark, str(tmp_path) + "/*/*.csv")
    for rules in ("sql", "frame"):
        prepared = normalize(raw, rules)
        nums = sorted(r["numero_auto"] for r in prepared.select("numero_auto").collect())
        assert "" not in nums and len(nums) == 7, rules
        assert prepared.filter(F.col("municipio") == "Município Ç").count() >= 1


def test_rows_per_file_and_first_columns(spark, tmp_path):
    from starmart.operators.profile import rows_per_source
    from starmart.sources.csv import first_file_columns

    make_files(str(tmp_path))
    raw = read_raw(spark, str(tmp_path) + "/*/*.csv")
    per_file = {os.path.basename(r["source_file"]): r["rows"] for r in rows_per_source(raw).orderBy("source_file").collect()}
    assert per_file == {"a.csv": 3, "b.csv": 2, "c.csv": 1, "d.csv": 1, "e.csv": 2}
    assert first_file_columns(spark, str(tmp_path) + "/*/*.csv")[0] == "Número do Auto"


def test_load_warehouse_end_to_end(spark, tmp_path):
    from starmart.plans.reports import REPORTS
    from starmart.plans.warehouse import load_warehouse, write_reports

    make_files(str(tmp_path / "in"))
    for rules in ("sql", "frame"):
        star = load_warehouse(spark, str(tmp_path / "in") + "/*/*.csv", str(tmp_path / rules / "star"), rules)
        assert star.fato_multa.count() == 7
        assert spark.read.parquet(str(tmp_path / rules / "star" / "fato_multa")).count() == 7
        paths = write_reports(star, str(tmp_path / rules / "reports"))
        assert set(paths) == set(REPORTS)
        q1 = spark.read.parquet(paths["report_q1"]).collect()
        assert sum(r["total_autos"] for r in q1) == 7


def test_quoted_fields_with_separator_and_newline(spark, tmp_path):
    base = tmp_path / "q"
    os.makedirs(base / "2022")
    vals = [_row(1)[c] for c in RAW_COLUMNS]
    vals[RAW_COLUMNS.index("municipio")] = '"A;B"'
    vals[RAW_COLUMNS.index("descricao_abreviada_infracao")] = '"linha 1\nlinha 2"'
    with open(base / "2022" / "m.csv", "w", encoding="utf-8") as f:
        f.write(";".join(HEADERS) + "\n" + ";".join(vals) + "\n")
    raw = read_raw(spark, str(base) + "/*/*.csv", multiline=True)
    r = raw.collect()
    assert len(r) == 1 and r[0]["municipio"] == "A;B" and r[0]["descricao_abreviada_infracao"] == "linha 1\nlinha 2"


def test_header_with_byte_order_mark(spark, tmp_path):
    assert resolve_header("﻿Número do Auto") == "numero_auto"
    base = tmp_path / "bom"
    os.makedirs(base / "2022")
    with open(base / "2022" / "b.csv", "w", encoding="utf-8-sig") as f:
        f.write(";".join(HEADERS) + "\n" + ";".join(_row(5)[c] for c in RAW_COLUMNS) + "\n")
    raw = read_raw(spark, str(base) + "/*/*.csv")
    assert [r["numero_auto"] for r in raw.collect()] == ["A5"]


def test_sniff_and_read_with_many_splits(spark, tmp_path):
    base = tmp_path / "split"
    rows = [[_row(i)[c] for c in RAW_COLUMNS] for i in range(400)]
    _write(str(base / "2022" / "big.csv"), HEADERS, rows, "latin-1")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        s = sniff_files(spark, str(base) + "/*/*.csv").collect()
        assert len(s) == 1 and s[0]["header_line"].startswith("N") and not s[0]["valid_utf8"]
        raw = read_raw(spark, str(base) + "/*/*.csv")
        assert raw.rdd.getNumPartitions() > 1
        assert raw.count() == 400
        assert raw.filter(F.col("municipio") == "Município Ç").count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_crlf_line_endings(spark, tmp_path):
    base = tmp_path / "crlf"
    os.makedirs(base / "2022")
    with open(base / "2022" / "w.csv", "w", encoding="latin-1", newline="") as f:
        f.write(";".join(HEADERS) + "\r\n" + ";".join(_row(9)[c] for c in RAW_COLUMNS) + "\r\n")
    raw = read_raw(spark, str(base) + "/*/*.csv")
    r = raw.first()
    assert r["numero_auto"] == "A9" and r["qtd_infracoes"] == "1" and r["municipio"] == "Município Ç"


def test_frame_keys_follow_first_seen_file_order(spark, tmp_path):
    from starmart.plans.warehouse import load_warehouse

    base = tmp_path / "fs"
    def rows(items):
        out = []
        for i, (mun, date) in enumerate(items):
            r = _row(i)
            r.update(municipio=mun, data_infracao=date, br_infracao="101", sentido_trafego="C")
            out.append([r[c] for c in RAW_COLUMNS])
        return out
    _write(str(base / "2022" / "a.csv"), HEADERS, rows([("Z", "2022-03-01"), ("A", "2022-01-05"), ("Z", "2022-01-01")]))
    _write(str(base / "2023" / "b.csv"), HEADERS, rows([("M", "2023-01-01"), ("A", "2021-12-31")]))
    star = load_warehouse(spark, str(base) + "/*/*.csv", rules="frame")
    loc = {r["municipio"]: r["id_localizacao_sk"] for r in star.dim_localizacao.collect()}
    assert loc == {"Z": 0, "A": 1, "M": 2}
    dates = [str(r["data_infracao"]) for r in star.dim_tempo.orderBy("id_tempo_sk").collect()]
    assert dates == ["2022-03-01", "2022-01-05", "2022-01-01", "2023-01-01", "2021-12-31"]
    sql = load_warehouse(spark, str(base) + "/*/*.csv", rules="sql")
    assert {r["municipio"]: r["id_localizacao_sk"] for r in sql.dim_localizacao.collect()} == {"A": 1, "M": 2, "Z": 3}


def test_recursive_folder_input(spark, tmp_path):
    make_files(str(tmp_path / "tree"))
    with open(tmp_path / "tree" / "2022" / "notes.txt", "w") as f:
        f.write("not a data file\n")
    raw = read_raw(spark, str(tmp_path / "tree"), recursive=True)
    assert raw.count() == 9
