"""Scans of the driver's Parquet tables and the ``fines_raw`` view derived from them.

``fines_raw`` turns every ``lineitem`` row (joined to its ``part``) into one
dirty 25-column raw fine record, so the warehouse flow runs on data whose
size grows with the input tables.  The same SQL text runs unchanged on Spark
and on the independent SQL engine used as the oracle.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

FINES_RAW_SQL = """
SELECT
  CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE 'A' || lpad(CAST(l_orderkey AS STRING), 8, '0') || '-' || CAST(l_linenumber AS STRING) END AS numero_auto,
  CASE WHEN l_orderkey % 97 = 0 THEN '' WHEN l_orderkey % 97 = 1 THEN '31/12/2023' WHEN l_orderkey % 97 = 2 THEN '2022-13-45'
       ELSE CAST(DATE '2022-01-01' + CAST((l_orderkey * 7 + l_linenumber * 131) % 1096 AS INT) AS STRING) END AS data_infracao,
  CASE CAST(l_linenumber % 4 AS INT) WHEN 0 THEN NULL WHEN 1 THEN '1' WHEN 2 THEN '2' ELSE '3' END AS indicador_abordagem,
  CASE CAST(l_partkey % 5 AS INT) WHEN 0 THEN 'AI' WHEN 1 THEN ' ait ' WHEN 2 THEN 'ANI' WHEN 3 THEN '' ELSE 'N/I' END AS assinatura_auto,
  CASE l_returnflag WHEN 'A' THEN 'C' WHEN 'R' THEN ' d' ELSE 'X' END AS sentido_trafego,
  substr('ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSROSCSPSETORREX', 1 + 2 * CAST((l_suppkey + l_orderkey) % 29 AS INT), 2) AS uf_infracao,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE lpad(CAST(l_suppkey % 40 AS STRING), 3, '0') END AS br_infracao,
  CASE CAST(l_linenumber % 5 AS INT) WHEN 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ',5'
       WHEN 2 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.5' WHEN 3 THEN '-3' ELSE 'km?' END AS km_infracao,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL WHEN l_suppkey % 23 = 1 THEN '' ELSE 'MUN ' || CAST(l_suppkey % 23 AS STRING) END AS municipio,
  CASE CAST(l_orderkey % 7 AS INT) WHEN 0 THEN 'S' WHEN 1 THEN 'N' WHEN 2 THEN 'AR' WHEN 3 THEN 'BR' WHEN 4 THEN '/' WHEN 5 THEN '99' ELSE '' END AS indicador_veiculo_estrangeiro,
  CASE CAST(l_partkey % 8 AS INT) WHEN 0 THEN 'SP' WHEN 1 THEN '-1' WHEN 2 THEN '2F' WHEN 3 THEN '/' WHEN 4 THEN 'EX' WHEN 5 THEN '''-1' WHEN 6 THEN '1-' ELSE 'pe' END AS uf_placa,
  CASE p_type WHEN 'ECONOMY' THEN 'Passageiro' WHEN 'SMALL' THEN 'TRACAO' WHEN 'MEDIUM' THEN '-1' WHEN 'PROMO' THEN '' WHEN 'STANDARD' THEN 'Competicao' ELSE 'OFICIAL' END AS descricao_especie_veiculo,
  CASE WHEN p_size % 10 = 0 THEN 'NA' ELSE p_brand END AS descricao_marca_veiculo,
  CASE CAST(p_size % 4 AS INT) WHEN 0 THEN 'Não encontrado' WHEN 1 THEN 'automovel' WHEN 2 THEN 'MOTOCICLO' ELSE 'Caminhão' END AS descricao_tipo_veiculo,
  p_name AS descricao_modelo_veiculo,
  CASE WHEN l_partkey % 41 = 0 THEN 'x' WHEN l_partkey % 41 = 1 THEN '5.0' ELSE CAST(50000 + l_partkey % 300 AS STRING) END AS codigo_infracao,
  'Infração ' || CAST(l_partkey % 300 AS STRING) || CASE WHEN l_linenumber = 1 THEN ' b' ELSE ' a' END AS descricao_abreviada_infracao,
  CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(160 + l_partkey % 90 AS STRING) || ', I' END AS enquadramento_infracao,
  'NA' AS inicio_vigencia_infracao, 'NA' AS fim_vigencia_infracao,
  CAST(CAST(l_quantity AS INT) + 80 AS STRING) AS medicao_infracao,
  CASE CAST(l_orderkey % 9 AS INT) WHEN 0 THEN NULL WHEN 1 THEN 'x' WHEN 2 THEN '-1' WHEN 3 THEN '2400' ELSE CAST(l_orderkey % 2360 AS STRING) END AS hora_infracao,
  CASE WHEN l_orderkey % 31 = 0 THEN 'n/d' WHEN l_orderkey % 31 = 1 THEN '1.234,56' ELSE CAST(CAST(l_quantity AS INT) + 80 AS STRING) || ',00' END AS medicao_considerada,
  CASE WHEN l_orderkey % 13 = 0 THEN '' WHEN l_orderkey % 13 = 1 THEN '0' WHEN l_orderkey % 13 = 2 THEN '-2,5' WHEN l_orderkey % 1009 = 3 THEN '900000'
       ELSE CAST(CAST(l_quantity * 4 AS INT) AS STRING) || ',' || CAST(l_linenumber AS STRING) END AS excesso_verificado,
  CASE WHEN l_orderkey % 17 = 0 THEN 'n/d' WHEN l_orderkey % 17 = 1 THEN '' ELSE CAST(1 + l_linenumber % 2 AS STRING) END AS qtd_infracoes
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

# The same records over seven years, with numbers outside the usual ranges.
FINES_WIDE_SQL = (
    FINES_RAW_SQL.replace("DATE '2022-01-01' + CAST((l_orderkey * 7 + l_linenumber * 131) % 1096", "DATE '2020-01-01' + CAST((l_orderkey * 7 + l_linenumber * 131) % 2557")
    .replace("WHEN l_partkey % 41 = 1 THEN '5.0'", "WHEN l_partkey % 41 = 1 THEN '5.0' WHEN l_partkey % 41 = 2 THEN '3000000000'")
    .replace("WHEN l_orderkey % 1009 = 3 THEN '900000'",
             "WHEN l_orderkey % 1009 = 3 THEN '900000' WHEN l_orderkey % 1009 = 5 THEN '1e300' WHEN l_orderkey % 1009 = 6 THEN '1e400' WHEN l_orderkey % 1009 = 7 THEN '123456789012'")
    .replace("WHEN l_orderkey % 17 = 1 THEN ''", "WHEN l_orderkey % 17 = 1 THEN '' WHEN l_orderkey % 1009 = 8 THEN '5000000000'")
)
VIEWS = {"fines_raw": FINES_RAW_SQL, "fines_wide": FINES_WIDE_SQL}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of one driver table, optionally with an explicit projection."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def fines_raw(spark: SparkSession, sf_dir: str, view: str = "fines_raw", partitions: int | None = None) -> DataFrame:
    """The dirty raw-fines view over ``lineitem`` JOIN ``part`` (25 STRING columns).

    ``partitions``: deal the lineitem rows out over so many tasks first, for an
    input kept in a few files with one row group each; by default the scan's
    own split is used.
    """
    text = VIEWS[view].replace("FROM lineitem JOIN part", "FROM {lineitem} JOIN {part}")
    lineitem = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"])
    if partitions:
        lineitem = lineitem.repartition(partitions)
    return spark.sql(text, lineitem=lineitem, part=table(spark, sf_dir, "part"))


_LANDING: dict[tuple, tuple[str, DataFrame]] = {}
_LANDING_LOCK = threading.Lock()


def landing(spark: SparkSession, sf_dir: str, view: str = "fines_raw") -> DataFrame:
    """A raw view written once per session as the raw landing table (Parquet in the shared folder).

    Every later step reads the landed rows, as a warehouse reads its raw
    table, instead of re-deriving them from lineitem and part.  The session
    setting ``starmart.landing.partitions`` is ``fines_raw``'s ``partitions``.
    """
    from starmart.session import work_dir, write_settings

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), view)
    with _LANDING_LOCK:
        if key not in _LANDING:
            path = work_dir(spark, f"landing_{view}")
            partitions = spark.conf.get("starmart.landing.partitions", None)
            raw = fines_raw(spark, sf_dir, view, int(partitions) if partitions else None)
            with write_settings(spark):
                raw.write.parquet(path)
            _LANDING[key] = (path, spark.read.parquet(path))
        return _LANDING[key][1]


def forget_landing(spark: SparkSession) -> None:
    """Drop this session's landing tables."""
    from starmart.session import drop_work

    app = spark.sparkContext.applicationId
    with _LANDING_LOCK:
        for key in [k for k in _LANDING if k[0] == app]:
            drop_work(spark, _LANDING.pop(key)[0])
