"""The generic operators applied to the driver's tables and to the raw fines.

Each function takes (spark, sf_dir) and returns a DataFrame; they exercise
the library operators on data whose size follows the input tables.  Large
fact-like inputs (lineitem, orders) are pre-aggregated on their foreign key
before joining the descriptive table, and small tables are broadcast only
after an exact row count.
"""

from __future__ import annotations

import threading
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import calendar as cal
from starmart.functions import decode as dec
from starmart.functions import parse as P
from starmart.functions import vocab as V
from starmart.functions.labels import colour, dot_thousands, millions_label, signed_percent, thousands
from starmart.functions.rounding import mean_of_cents, to_cents
from starmart.functions.text import null_default
from starmart.operators import profile as prof
from starmart.operators import quality as qa
from starmart.operators.distinct import distinct_written
from starmart.operators.joins import anti_join, maybe_broadcast, semi_join
from starmart.operators.keys import assign_dense_keys, build_dimension, measured
from starmart.operators.metrics import change_vs_previous, pivot_change, rank_by, share_of_total, stack_base, top_k
from starmart.schemas import RAW_COLUMNS, RAW_COLUMNS_AND_HEADERS
from starmart.session import work_dir
from starmart.sources.csv import MALFORMED, first_file_columns, malformed_per_file, read_raw, source_year, write_csv_batches
from starmart.sources.ingest import read_once
from starmart.sources.sinks import append_table, create_raw_table, write_table
from starmart.sources.tables import landing, table


def _small(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if its measured rows and bytes pass the size check."""
    return maybe_broadcast(df, *measured(df))


# ---------------------------------------------------------------------------
# Share, change, ranking, pivot, stack on the TPC-H-like tables
# ---------------------------------------------------------------------------
def share_by_brand(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    part = table(spark, sf, "part", ["p_partkey", "p_brand"])
    by_brand = li.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.sum("q").cast("long").alias("total_qty"))
    return share_of_total(by_brand, "total_qty")


def _orders_by_customer_year(spark: SparkSession, sf: str, quarter: bool = False) -> DataFrame:
    o = table(spark, sf, "orders", ["o_custkey", "o_orderdate"])
    keys = [F.col("o_custkey"), F.year("o_orderdate").alias("ano")]
    if quarter:
        keys.append(F.quarter("o_orderdate").alias("trimestre"))
    return o.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def yoy_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    pre = _orders_by_customer_year(spark, sf)
    cust = table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    nation = _small(table(spark, sf, "nation", ["n_nationkey", "n_name"]))
    g = (
        pre.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "ano")
        .agg(F.sum("n").cast("long").alias("total_pedidos"))
    )
    return change_vs_previous(g, ["n_name"], ["ano"], "total_pedidos", "variacao_pct_ano_anterior", kind="pct")


def qoq_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    pre = _orders_by_customer_year(spark, sf, quarter=True)
    cust = table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    g = (
        pre.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", "ano", "trimestre")
        .agg(F.sum("n").cast("long").alias("total_pedidos"))
    )
    return change_vs_previous(g, ["c_mktsegment"], ["ano", "trimestre"], "total_pedidos", "variacao_trimestre_anterior")


def top_parts(spark: SparkSession, sf: str, k: int = 10) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("total_qty"))
    top = top_k(li, [F.col("total_qty").desc(), "l_partkey"], k)
    part = table(spark, sf, "part", ["p_partkey", "p_name"])
    # names are attached after the limit: the broadcast side holds exactly k rows
    named = part.join(F.broadcast(top), F.col("p_partkey") == F.col("l_partkey")).select("p_partkey", "p_name", "total_qty")
    return named.orderBy(*top_parts_order())


def top_parts_order():
    return [F.col("total_qty").desc(), F.col("p_partkey")]


def ordered(df: DataFrame, order: list) -> DataFrame:
    """``df`` with its row numbers in ``order`` as the column ``ordem``."""
    return assign_dense_keys(df, order, "ordem").df


def rank_brands(spark: SparkSession, sf: str, k: int = 10) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    part = table(spark, sf, "part", ["p_partkey", "p_brand"])
    g = li.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.sum("n").cast("long").alias("total_linhas"))
    return rank_by(g, [F.col("total_linhas").desc(), "p_brand"], k).select("ranking", "p_brand", "total_linhas")


def _orders_by_region_year(spark: SparkSession, sf: str) -> DataFrame:
    pre = _orders_by_customer_year(spark, sf)
    cust = table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    nation = _small(table(spark, sf, "nation", ["n_nationkey", "n_regionkey"]))
    region_t = _small(table(spark, sf, "region", ["r_regionkey", "r_name"]))
    return (
        pre.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region_t, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "r_regionkey", "ano")
        .agg(F.sum("n").cast("long").alias("total_pedidos"))
    )


def region_year_pivot(spark: SparkSession, sf: str) -> DataFrame:
    g = _orders_by_region_year(spark, sf)
    span = table(spark, sf, "orders", ["o_orderdate"]).agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    years = list(range(span[0], span[1] + 1))
    wide = pivot_change(g, "r_name", "ano", years, "total_pedidos", years[0], years[-1], out="var_pct", scale=1)
    return wide.na.fill(0, subset=[str(y) for y in years])


def stack_by_year(spark: SparkSession, sf: str) -> DataFrame:
    g = _orders_by_region_year(spark, sf)
    return stack_base(g, ["ano"], "r_name", "r_regionkey", "total_pedidos", out="base").select("ano", "r_name", "total_pedidos", "base")


def outlier_rows(spark: SparkSession, sf: str, threshold: float = 104000.0, k: int = 20) -> DataFrame:
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])
    sane = li.filter((F.col("l_quantity") > 0) & (F.col("l_quantity") <= 50))
    out = sane.filter(F.col("l_extendedprice") > threshold).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return top_k(out, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"], k)


def mean_nonzero(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", ["l_returnflag", "l_discount"])
    d = F.col("l_discount").cast("decimal(10,2)")
    nz = F.when(d != 0, d)
    g = li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count(nz).alias("linhas_nao_zero"),
        F.sum(to_cents(nz)).alias("__s"),
        F.max(d).alias("maior_desconto"),
    )
    return g.select(
        "l_returnflag", "linhas", "linhas_nao_zero",
        mean_of_cents(F.col("__s"), F.col("linhas_nao_zero"), 4).alias("media_desconto_nao_zero"),
        "maior_desconto",
    )


def semi_exists(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer", ["c_custkey", "c_name"])
    orders = table(spark, sf, "orders", ["o_custkey"]).withColumnRenamed("o_custkey", "c_custkey")
    return semi_join(cust, orders, "c_custkey")


def orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return anti_join(orders, table(spark, sf, "customer", ["c_custkey"]), "o_custkey", "c_custkey")


# ---------------------------------------------------------------------------
# Rule tables over the raw fines: (before, after_sql, after_frame, n)
# ---------------------------------------------------------------------------
def _rule_table(spark: SparkSession, sf: str, column: str, sql_expr, frame_expr) -> DataFrame:
    raw = landing(spark, sf)
    return raw.groupBy(
        F.col(column).alias("before"), sql_expr.alias("after_sql"), frame_expr.alias("after_frame")
    ).agg(F.count(F.lit(1)).cast("long").alias("n"))


def scalar_region(spark, sf):
    return _rule_table(spark, sf, "uf_infracao", dec.region_for(null_default("uf_infracao"), "sql"), dec.region_for("uf_infracao", "frame"))


def scalar_direction(spark, sf):
    return _rule_table(spark, sf, "sentido_trafego", dec.direction("sentido_trafego", "sql"), dec.direction("sentido_trafego", "frame"))


def scalar_doc_type(spark, sf):
    return _rule_table(spark, sf, "assinatura_auto", dec.doc_type("assinatura_auto", "sql"), dec.doc_type("assinatura_auto", "frame"))


def scalar_species(spark, sf):
    c = "descricao_especie_veiculo"
    return _rule_table(spark, sf, c, dec.species(null_default(c), "sql"), dec.species(c, "frame"))


def scalar_missing_terms(spark, sf):
    c = "descricao_tipo_veiculo"
    return _rule_table(spark, sf, c, dec.vehicle_type(null_default(c), "sql"), dec.vehicle_type(c, "frame"))


def scalar_make(spark, sf):
    c = "descricao_marca_veiculo"
    return _rule_table(spark, sf, c, dec.make(null_default(c), "sql"), dec.make(c, "frame"))


def scalar_plate(spark, sf):
    return _rule_table(spark, sf, "uf_placa", dec.plate_state("uf_placa", "sql"), dec.plate_state("uf_placa", "frame"))


def scalar_foreign(spark, sf):
    c = "indicador_veiculo_estrangeiro"
    return _rule_table(spark, sf, c, dec.foreign_flag(c), dec.foreign_flag(c))


def parse_km_both(spark, sf):
    return _rule_table(spark, sf, "km_infracao", P.km("km_infracao", "sql"), P.km("km_infracao", "frame"))


def _field_rules(spark, sf, specs) -> DataFrame:
    """(field, before, after_sql, after_frame, n) of several fields in one scan and one grouped aggregate."""
    text = lambda e: e.cast("string")
    rows = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("before"), text(sql_e).alias("after_sql"), text(frame_e).alias("after_frame"))
        for f, sql_e, frame_e in specs
    ])
    return landing(spark, sf).select(F.inline(rows)).groupBy("field", "before", "after_sql", "after_frame").agg(F.count(F.lit(1)).cast("long").alias("n"))


def parse_ints(spark, sf):
    return _field_rules(spark, sf, [
        ("codigo_infracao", P.guarded_int("codigo_infracao", 0), P.frame_int("codigo_infracao", 0)),
        ("qtd_infracoes", P.guarded_int("qtd_infracoes", 1), P.frame_int("qtd_infracoes", 1)),
        ("hora_infracao", P.guarded_hour("hora_infracao"), F.col("hora_infracao")),
    ])


def parse_decimal_comma(spark, sf):
    return _field_rules(spark, sf, [
        (c, P.decimal_comma(c, "sql"), P.decimal_comma(c, "frame")) for c in ("medicao_considerada", "excesso_verificado")
    ])


def parse_date(spark, sf):
    raw = landing(spark, sf)
    return raw.groupBy(
        F.col("data_infracao").alias("before"), P.iso_date("data_infracao").alias("after")
    ).agg(F.count(F.lit(1)).cast("long").alias("n"))


def holiday_flag(dim_tempo: DataFrame) -> DataFrame:
    """Holiday dates of the time dimension under both calendars (they agree for the listed years)."""
    dates = dim_tempo.select("data_infracao")
    flags = dates.select(
        "data_infracao",
        cal.is_holiday("data_infracao", "listed").alias("feriado_listado"),
        cal.is_holiday("data_infracao", "computed").alias("feriado_calculado"),
        cal.weekday_name("data_infracao").alias("dia_semana"),
    )
    return flags.filter(F.col("feriado_listado") | F.col("feriado_calculado"))


# ---------------------------------------------------------------------------
# Profiling and data tests over the raw fines
# ---------------------------------------------------------------------------
def profile_nulls(spark, sf):
    return prof.profile_nulls(landing(spark, sf))


def profile_dates(spark, sf):
    return prof.profile_dates(landing(spark, sf).withColumn("ano_carga", load_year()), "data_infracao", year=F.col("ano_carga"))


def load_year():
    """The year whose load a raw record came with; the derived records are dealt over three loads by their number."""
    return F.expr(LOAD_YEAR_SQL)


LOAD_YEAR_SQL = "CAST(2022 + coalesce(CAST(substr(numero_auto, 2, 8) AS INT), 0) % 3 AS INT)"


def profile_hours(spark, sf):
    return prof.profile_hours(landing(spark, sf), "hora_infracao")


def profile_duplicates(spark, sf):
    return prof.duplicate_count(landing(spark, sf), "numero_auto")


def profile_text(spark, sf):
    return prof.describe_text(landing(spark, sf), ["medicao_infracao", "medicao_considerada"])


PROFILED_CATEGORIES = ["uf_infracao", "uf_placa", "indicador_veiculo_estrangeiro", "indicador_abordagem", "assinatura_auto", "sentido_trafego"]


def profile_values(spark, sf):
    return prof.distinct_values(landing(spark, sf), PROFILED_CATEGORIES)


def profile_terms(spark, sf):
    return prof.term_counts(landing(spark, sf), "descricao_marca_veiculo", V.INSPECTED_TERMS)


INSPECTED = ["descricao_especie_veiculo", "descricao_tipo_veiculo", "descricao_marca_veiculo", "fim_vigencia_infracao"]


def inspect_values(spark, sf):
    """Distinct values of the inspected vehicle columns and of the end of validity, per load year."""
    raw = landing(spark, sf).select(load_year().alias("ano_carga"), *INSPECTED)
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in INSPECTED]))
    return raw.select("ano_carga", stack).distinct()


def profile_replaced(spark, sf):
    """Numbers that take a field's default only because its type cannot hold them, counted per rule set and field."""
    fields = [("codigo_infracao", "int"), ("km_infracao", "int"), ("qtd_infracoes", "int"), ("hora_infracao", "int"), ("medicao_considerada", "decimal"), ("excesso_verificado", "decimal")]
    cases = [(rules, f, kind) for rules in ("sql", "frame") for f, kind in fields if rules == "sql" or f in ("codigo_infracao", "qtd_infracoes")]
    one = landing(spark, sf, "fines_wide").agg(*[F.count_if(P.out_of_range(f, kind, rules)).alias(f"{rules}_{f}") for rules, f, kind in cases])
    rows = F.array(*[F.struct(F.lit(rules).alias("rules"), F.lit(f).alias("field"), F.col(f"{rules}_{f}").cast("long").alias("n")) for rules, f, _ in cases])
    return one.select(F.inline(rows))


def test_not_null(spark, sf):
    return qa.check_not_null(landing(spark, sf), "numero_auto")


def test_unique(prepared: DataFrame) -> DataFrame:
    return qa.check_unique(prepared, "numero_auto")


def test_accepted(prepared: DataFrame) -> DataFrame:
    return qa.check_accepted(prepared, "indicador_veiculo_estrangeiro", ["S", "N", "N/I"])


# ---------------------------------------------------------------------------
# Set operations on the raw fines
# ---------------------------------------------------------------------------
def union_evolving(spark, sf):
    """Two loads with different column sets, unioned by name; absent columns are NULL."""
    raw = landing(spark, sf)
    a = raw.select("numero_auto", "data_infracao", "uf_infracao", "km_infracao")
    b = raw.select("municipio", "numero_auto", "data_infracao", F.lit("x").alias("coluna_extra"))
    u = a.unionByName(b, allowMissingColumns=True)
    keep = [c for c in RAW_COLUMNS if c in u.columns]  # whitelist: unknown columns dropped
    return u.select(*keep)


def append_then_distinct(spark, sf):
    """The same load appended twice, then whole-row duplicates removed."""
    raw = landing(spark, sf)
    return raw.unionByName(raw).distinct()


def profile_report(spark, sf):
    """The full profiling report of the raw fines, one per load year, as one long table."""
    return prof.profile(
        landing(spark, sf).withColumn("ano_carga", load_year()), date_col="data_infracao", year=F.col("ano_carga"), hour_col="hora_infracao",
        key_col="numero_auto", text_cols=["medicao_infracao", "medicao_considerada"], value_cols=PROFILED_CATEGORIES,
        sample_cols=["numero_auto", "medicao_infracao", "medicao_considerada"], by="ano_carga",
    )


# ---------------------------------------------------------------------------
# Files: written once per session and input folder, read back
# ---------------------------------------------------------------------------
_FILES: dict[tuple, str] = {}
_FILES_LOCK = threading.Lock()


def _written(spark: SparkSession, sf: str, name: str, write) -> str:
    """The folder ``write(folder)`` filled, made once per session and input."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    with _FILES_LOCK:
        if key not in _FILES:
            base = work_dir(spark, name)
            write(base)
            _FILES[key] = base
        return _FILES[key]


def _half():
    return F.col("numero_auto").isNull() | (F.pmod(F.xxhash64("numero_auto"), F.lit(2)) == 0)


def _even():
    return F.col("numero_auto").isNull() | (F.substring("numero_auto", 2, 8).cast("int") % 2 == 0)


def _two_layouts(spark: SparkSession, sf: str) -> str:
    """Raw fines of even number as UTF-8 files with the accented source headers (folder 2023), the others as ISO-8859-1 files with
    unaccented headers in reverse order (folder 2024)."""
    heads = [h for _, h in RAW_COLUMNS_AND_HEADERS]
    plain = ["".join(ch for ch in unicodedata.normalize("NFD", h) if not unicodedata.combining(ch)).upper() for h in heads]
    rev = list(reversed(RAW_COLUMNS))

    def write(base: str) -> None:
        raw = landing(spark, sf)
        write_csv_batches(raw.filter(_even()), f"{base}/2023", heads)
        write_csv_batches(raw.filter(~_even()).select(*rev), f"{base}/2024", [plain[RAW_COLUMNS.index(c)] for c in rev], encoding="ISO-8859-1")

    return _written(spark, sf, "csv_two_layouts", write)


def csv_roundtrip(spark, sf):
    """Raw fines written as delimited files in two layouts, then ingested back.

    The ingest must sniff both encodings, reconcile both headers and union
    them.  Blank and NULL fields both come back as '' (a text file keeps no
    NULLs).
    """
    return read_once(spark, f"{_two_layouts(spark, sf)}/*/*.csv", with_source=False)


def rows_per_load(spark, sf):
    """Row totals per load folder, summed from the totals per file."""
    raw = read_once(spark, f"{_two_layouts(spark, sf)}/*/*.csv")
    files = prof.rows_per_source(raw)
    return files.groupBy(source_year().alias("ano")).agg(F.sum("rows").cast("long").alias("linhas"))


def first_file_header(spark, sf):
    """Header names of the first file in name order."""
    names = first_file_columns(spark, f"{_two_layouts(spark, sf)}/*/*.csv")
    return spark.createDataFrame(list(enumerate(names, 1)), "posicao int, coluna string")


QUOTED_HEADERS = ["Número do Auto", "Município", "Descrição Modelo Veículo", "UF Infração"]
#: municipio of the quoting records: backslash before a separator, quotes, separators, blanks, only quotes.
QUOTED_SQL = """
SELECT 'Q' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS numero_auto,
  CASE CAST(l_linenumber % 7 AS INT) WHEN 0 THEN concat('C:', chr(92)) WHEN 1 THEN 'S "X" Y' WHEN 2 THEN 'a;b;c' WHEN 3 THEN '"' WHEN 4 THEN concat(chr(92), '"', chr(92), ';')
    WHEN 5 THEN '  ' ELSE 'São João' END AS municipio,
  p_name AS descricao_modelo_veiculo, CASE WHEN l_suppkey % 2 = 0 THEN 'SP' ELSE '' END AS uf_infracao
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def csv_quoting(spark, sf):
    """Values with quotes, backslashes and separators, in files of two layouts, some of which begin with blank lines.

    Half the records go through the library's writer; the other half are
    written as plain lines, columns reversed, below two blank lines (one of a tab) and the
    header, so that files which share their first line differ in layout.
    """

    def write(base: str) -> None:
        text = QUOTED_SQL.replace("FROM lineitem JOIN part", "FROM {lineitem} JOIN {part}")
        rows = spark.sql(text, lineitem=table(spark, sf, "lineitem"), part=table(spark, sf, "part"))
        write_csv_batches(rows.filter(_half()), f"{base}/a", QUOTED_HEADERS)
        cell = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
        n = spark.conf.get("spark.sql.shuffle.partitions")
        for layout, cols, heads in (("b", list(reversed(rows.columns)), list(reversed(QUOTED_HEADERS))), ("c", rows.columns, QUOTED_HEADERS)):
            mine = rows.filter(~_half() & (F.pmod(F.xxhash64("numero_auto"), F.lit(4)) == (1 if layout == "b" else 3)))
            body = mine.select(F.pmod(F.xxhash64("numero_auto", F.lit(7)), F.lit(int(n))).alias("p"), F.lit(3).alias("o"), F.concat_ws(";", *[cell(c) for c in cols]).alias("value"))
            top = body.select("p").distinct().select("p", F.inline(F.array(*[F.struct(F.lit(o).alias("o"), F.lit(v).alias("value")) for o, v in ((0, ""), (1, "\t" if layout == "b" else "  "), (2, ";".join(heads)))])))
            lines = body.unionByName(top.select("p", "o", "value")).repartition("p").sortWithinPartitions("p", "o")
            lines.select("p", "value").write.partitionBy("p").option("compression", "none").text(f"{base}/{layout}")

    base = _written(spark, sf, "csv_quoting", write)
    paths = [f"{base}/a/*.csv", f"{base}/b/*/*.txt", f"{base}/c/*/*.txt"]
    raw = read_raw(spark, paths, with_source=False, with_malformed=True)
    return raw.filter(F.col(MALFORMED).isNull()).select("numero_auto", "municipio", "descricao_modelo_veiculo", "uf_infracao")


def csv_malformed(spark, sf):
    """Records with a field too many or too few keep what fits and are counted per load."""

    def write(base: str) -> None:
        li = table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
        cells = F.concat_ws(";", F.concat(F.lit("M"), F.col("l_orderkey").cast("string")), F.lit("SP"))
        bad = F.col("l_orderkey") % 10
        line = F.when(bad == 0, F.concat(cells, F.lit(";x;y"))).when(bad == 1, F.col("l_orderkey").cast("string")).otherwise(cells)
        n = spark.conf.get("spark.sql.shuffle.partitions")
        body = li.select(F.pmod(F.col("l_orderkey"), F.lit(int(n))).alias("p"), F.lit(1).alias("o"), line.alias("value"))
        top = body.select("p").distinct().select("p", F.lit(0).alias("o"), F.lit("Número do Auto;UF Infração").alias("value"))
        body.unionByName(top).repartition("p").sortWithinPartitions("p", "o").select("p", "value").write.partitionBy("p").text(f"{base}/2023")

    raw = read_raw(spark, f"{_written(spark, sf, 'csv_malformed', write)}/2023/*/*.txt", with_malformed=True)
    return malformed_per_file(raw, "numero_auto").agg(
        F.sum("rows").cast("long").alias("linhas"), F.sum("malformed").cast("long").alias("malformadas"), F.sum("with_key").cast("long").alias("com_numero")
    )


def encoding_fallback(spark, sf):
    """A Latin-1 file is read as such; one whose header holds replacement characters is read as UTF-8 with bad bytes replaced."""

    def write(base: str) -> None:
        supplier = table(spark, sf, "supplier", ["s_suppkey"]).select(F.concat(F.lit("E"), F.col("s_suppkey").cast("string")).alias("a"), F.lit("Ação").alias("b"))
        write_csv_batches(supplier, f"{base}/latin", ["Número do Auto", "Município"], encoding="ISO-8859-1")
        # the same bytes below a header that was once decoded with replacement characters
        n = F.pmod(F.xxhash64("a"), F.lit(4))
        latin = F.encode(F.concat_ws(";", "a", "b"), "ISO-8859-1")
        head = F.encode(F.lit("N\ufffdmero do Auto;Munic\ufffdpio"), "UTF-8")
        body = supplier.select(n.alias("p"), F.lit(1).alias("o"), latin.alias("line"))
        top = body.select("p").distinct().select("p", F.lit(0).alias("o"), head.alias("line"))
        lines = body.unionByName(top).repartition("p").sortWithinPartitions("p", "o")
        # a text file of raw bytes: the text writer takes the bytes of a string as they are
        lines.select("p", F.col("line").cast("string").alias("value")).write.partitionBy("p").text(f"{base}/replaced")

    base = _written(spark, sf, "csv_encodings", write)
    latin = read_raw(spark, f"{base}/latin/*.csv", with_source=False).select("numero_auto", "municipio", F.lit("latin").alias("arquivo"))
    other = read_raw(spark, f"{base}/replaced/*/*.txt", with_source=False).select("numero_auto", "municipio", F.lit("replaced").alias("arquivo"))
    return latin.unionByName(other)


def sink_partitions(spark, sf):
    """A partitioned table after a load, the same load again for one year, and an append; rows per year."""

    def write(base: str) -> None:
        orders = table(spark, sf, "orders", ["o_orderkey", "o_orderdate"]).select("o_orderkey", F.year("o_orderdate").alias("ano"))
        write_table(orders, path=base, partition_by=["ano"])
        again = orders.filter((F.col("ano") == 1997) & (F.col("o_orderkey") % 2 == 0))
        write_table(again, path=base, mode="overwrite_partitions", partition_by=["ano"])
        append_table(orders.filter(F.col("ano") == 1998), path=base, partition_by=["ano"])

    base = _written(spark, sf, "sink_partitions", write)
    return spark.read.parquet(base).groupBy("ano").agg(F.count(F.lit(1)).cast("long").alias("linhas"), F.countDistinct("o_orderkey").cast("long").alias("pedidos"))


def sink_raw_table(spark, sf):
    """The raw landing table created if absent (twice), appended to twice and made distinct."""
    raw = landing(spark, sf)

    def write(base: str) -> None:
        name = "raw_" + base.rsplit("-", 1)[-1]
        for _ in range(2):
            create_raw_table(spark, name, base)
        for _ in range(2):
            append_table(raw, path=base)
        spark.sql(f"DROP TABLE {name}")

    return distinct_written(spark, _written(spark, sf, "sink_raw_table", write), raw.schema)


def sql_over_views(star) -> DataFrame:
    """Yearly volume per state in SQL over the star's views."""
    spark = star.dim_tempo.sparkSession
    tables = {n: star.table(n) for n in ("fato_multa", "dim_tempo", "dim_localizacao")}
    return spark.sql(
        "SELECT t.ano, l.uf_infracao, COUNT(*) AS autos, CAST(SUM(f.qtd_infracoes) AS BIGINT) AS infracoes FROM {fato_multa} f "
        "JOIN {dim_tempo} t ON t.id_tempo_sk = f.id_tempo_sk JOIN {dim_localizacao} l ON l.id_localizacao_sk = f.id_localizacao_sk GROUP BY t.ano, l.uf_infracao",
        **tables,
    )


def first_seen_keys(spark, sf):
    """Customers numbered by their first order, as rows in file order would be."""
    orders = table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate"]).withColumn("lugar", F.struct("o_orderdate", "o_orderkey", "o_custkey"))
    return build_dimension(orders, ["o_custkey"], "id_cliente_sk", first=0, first_seen="lugar").df


def orphan_rows_shifted(spark, sf):
    """Orders whose customer is missing, after every fifth customer key is moved out of the table."""
    orders = table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    moved = orders.withColumn("o_custkey", F.when(F.col("o_custkey") % 5 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")))
    return anti_join(moved, table(spark, sf, "customer", ["c_custkey"]), "o_custkey", "c_custkey")


def test_relationships(spark, sf):
    """The data tests on a child table with orphans, blanks and an unlisted value."""
    orders = table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    key = F.when(F.col("o_custkey") % 5 == 0, -F.col("o_custkey")).when(F.col("o_custkey") % 7 == 0, None).otherwise(F.col("o_custkey"))
    child = orders.withColumn("o_custkey", key)
    checks = [
        qa.Check("pedidos", "o_custkey", "relationships", parent="clientes", parent_column="c_custkey"),
        qa.Check("pedidos", "o_custkey", "not_null"),
        qa.Check("pedidos", "o_orderstatus", "accepted_values", values=["F", "O"]),
        qa.Check("clientes", "c_custkey", "unique"),
    ]
    return qa.run_checks({"pedidos": child, "clientes": table(spark, sf, "customer", ["c_custkey"])}, checks)


def labels_and_formats(star_q1: DataFrame, years: list[int]) -> DataFrame:
    """Region summary with chart labels: thousands, millions label, signed % change, colour."""
    wide = pivot_change(star_q1, "regiao", "ano", years, "total_infracoes", years[0], years[-1], out="var", scale=1)
    last = str(years[-1])
    return wide.select(
        "regiao",
        thousands(last).alias("total_ultimo_ano"),
        dot_thousands(last).alias("total_ultimo_ano_br"),
        millions_label(last).alias("total_milhoes"),
        signed_percent("var").alias("variacao"),
        colour("regiao", V.REGION_COLOURS).alias("cor"),
    )


GENERIC = {
    "share_by_brand": share_by_brand,
    "yoy_by_nation": yoy_by_nation,
    "qoq_by_segment": qoq_by_segment,
    "top_parts": top_parts,
    "rank_brands": rank_brands,
    "region_year_pivot": region_year_pivot,
    "stack_by_year": stack_by_year,
    "outlier_rows": outlier_rows,
    "mean_nonzero": mean_nonzero,
    "semi_exists": semi_exists,
    "orphan_rows": orphan_rows,
    "scalar_region": scalar_region,
    "scalar_direction": scalar_direction,
    "scalar_doc_type": scalar_doc_type,
    "scalar_species": scalar_species,
    "scalar_missing_terms": scalar_missing_terms,
    "scalar_make": scalar_make,
    "scalar_plate": scalar_plate,
    "scalar_foreign": scalar_foreign,
    "parse_km_both": parse_km_both,
    "parse_ints": parse_ints,
    "parse_decimal_comma": parse_decimal_comma,
    "parse_date": parse_date,
    "profile_nulls": profile_nulls,
    "profile_dates": profile_dates,
    "profile_hours": profile_hours,
    "profile_duplicates": profile_duplicates,
    "profile_text": profile_text,
    "profile_values": profile_values,
    "profile_terms": profile_terms,
    "test_not_null": test_not_null,
    "union_evolving": union_evolving,
    "profile_report": profile_report,
    "csv_roundtrip": csv_roundtrip,
    "csv_quoting": csv_quoting,
    "csv_malformed": csv_malformed,
    "encoding_fallback": encoding_fallback,
    "rows_per_load": rows_per_load,
    "first_file_header": first_file_header,
    "sink_partitions": sink_partitions,
    "sink_raw_table": sink_raw_table,
    "first_seen_keys": first_seen_keys,
    "orphan_rows_shifted": orphan_rows_shifted,
    "test_relationships": test_relationships,
    "inspect_values": inspect_values,
    "profile_replaced": profile_replaced,
    "append_then_distinct": append_then_distinct,
}
