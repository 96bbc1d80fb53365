"""RAW (25 strings) -> PREPARED (typed, cleaned) under a selectable rule set.

``rules='sql'`` (default) reproduces the warehouse SQL cleaning; ``'frame'``
reproduces the data-frame cleaning.  Differences (see each function in
``starmart.functions``) in short:

========================  =============================  ==========================================
field                     sql                            frame
========================  =============================  ==========================================
whole-row duplicates      removed (distinct)             kept
blank text fields         only NULL replaced             NULL and '' -> NÃO INFORMADO
km                        INT, integer text only         DOUBLE, one ',' / '.' fraction allowed
medição / excesso         DECIMAL(10,2)                  DOUBLE
hora                      INT (NULL stays NULL)          kept as text
species                   unknown words kept             unknown words -> NÃO INFORMADO
região / sentido default  NÃO INFORMADO                  Não informado
========================  =============================  ==========================================

Policies chosen where the published code would raise or is ill-defined:
an impossible date (``2022-13-45``) becomes NULL and the row is dropped; a
numeric overflow becomes the field default; in the frame rules a NULL
(column missing from a file) is treated like a blank, never as the text
``NAN``.  Every expression is a native Column (generated JVM code, no
Python per row).  Under the frame rules a ``source_position`` column, when
the raw rows carry one, is kept for first-seen key numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import calendar as cal
from starmart.functions import decode as dec
from starmart.functions import parse as P
from starmart.functions.text import blank_default, null_default
from starmart.operators.joins import can_broadcast
from starmart.schemas import PREPARED_COLUMNS, RAW_COLUMNS
from starmart.session import work_dir

SQL, FRAME = "sql", "frame"

POSITION = "source_position"
VALID = "numero_auto IS NOT NULL AND data_infracao IS NOT NULL"


RAW_ROW = "raw"


def _conform(raw: DataFrame, keep_position: bool = False) -> DataFrame:
    """Project to the 25 raw columns (missing ones as NULL strings); optionally keep the row position."""
    cols = []
    present = set(raw.columns)
    for c in RAW_COLUMNS:
        cols.append(F.col(c).cast("string").alias(c) if c in present else F.lit(None).cast("string").alias(c))
    if keep_position and POSITION in present:
        cols.append(F.col(POSITION))
    return raw.select(*cols)


def _raw_row(keep: bool) -> list:
    return [F.struct(*RAW_COLUMNS).alias(RAW_ROW)] if keep else []


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()`` for wide rows of which few come twice: only rows whose 64-bit hash comes twice are compared.

    The hashes that come more than once are found first, in a job over the hashes alone, and written.  A row with a
    hash of its own equals no other row and stays where it is.  Where too many hashes repeat to send to every task,
    all rows are compared.
    """
    spark, at = df.sparkSession, "__hash"
    # NULLs do not change a hash: which columns are NULL is hashed too
    hashed = df.withColumn(at, F.xxhash64(*df.columns, F.array(*[F.col(c).isNull() for c in df.columns])))
    path = work_dir(spark, "repeated_rows")
    hashed.groupBy(at).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(at).alias("__repeated")).write.parquet(path)
    repeated = spark.read.schema("__repeated long").parquet(path)
    few = repeated.count()
    if not few:
        return df
    if not can_broadcast(repeated, few):
        return df.distinct()
    marked = hashed.join(F.broadcast(repeated), F.col(at) == F.col("__repeated"), "left")
    alone, again = marked.filter(F.col("__repeated").isNull()), marked.filter(F.col("__repeated").isNotNull())
    return alone.select(*df.columns).unionByName(again.select(*df.columns).distinct())


def normalize_sql(raw: DataFrame, valid_only: bool = True, keep_raw: bool = False) -> DataFrame:
    r = distinct_rows(_conform(raw))
    uf = null_default("uf_infracao")
    typed = r.select(
        F.col("numero_auto"),
        uf.alias("uf_infracao"),
        null_default("municipio").alias("municipio"),
        null_default("indicador_abordagem").alias("indicador_abordagem"),
        null_default("br_infracao").alias("br_infracao"),
        dec.doc_type("assinatura_auto", SQL).alias("assinatura_auto"),
        dec.direction("sentido_trafego", SQL).alias("sentido_trafego"),
        dec.foreign_flag("indicador_veiculo_estrangeiro").alias("indicador_veiculo_estrangeiro"),
        dec.plate_state("uf_placa", SQL).alias("uf_placa"),
        dec.species(null_default("descricao_especie_veiculo"), SQL).alias("descricao_especie_veiculo"),
        dec.vehicle_type(null_default("descricao_tipo_veiculo"), SQL).alias("descricao_tipo_veiculo"),
        dec.make(null_default("descricao_marca_veiculo"), SQL).alias("descricao_marca_veiculo"),
        null_default("descricao_modelo_veiculo").alias("descricao_modelo_veiculo"),
        null_default("descricao_abreviada_infracao").alias("descricao_abreviada_infracao"),
        null_default("enquadramento_infracao").alias("enquadramento_infracao"),
        P.guarded_int("codigo_infracao", 0).alias("codigo_infracao"),
        P.km("km_infracao", SQL).alias("km_infracao"),
        P.guarded_int("qtd_infracoes", 1).alias("qtd_infracoes"),
        P.guarded_hour("hora_infracao").alias("hora_infracao"),
        P.decimal_comma("medicao_considerada", SQL).alias("medicao_considerada"),
        P.decimal_comma("excesso_verificado", SQL).alias("excesso_verificado"),
        P.iso_date("data_infracao").alias("data_infracao"),
        *_raw_row(keep_raw),
    )
    if valid_only:
        typed = typed.filter(VALID)
    parts = cal.date_parts("data_infracao")
    return typed.select(
        *[F.col(c) for c in typed.columns],
        *[v.alias(k) for k, v in parts.items()],
        dec.region_for("uf_infracao", SQL).alias("regiao_infracao"),
    ).select(*PREPARED_COLUMNS, *([RAW_ROW] if keep_raw else []))


def normalize_frame(raw: DataFrame, holidays: str = "listed", valid_only: bool = True, keep_raw: bool = False) -> DataFrame:
    r = _conform(raw, keep_position=True)
    pos = [F.col(POSITION)] if POSITION in r.columns else []
    d = P.iso_date("data_infracao")
    typed = r.select(
        F.col("numero_auto"),
        blank_default("uf_infracao").alias("uf_infracao"),
        blank_default("municipio").alias("municipio"),
        F.col("indicador_abordagem"),
        F.col("br_infracao"),
        dec.doc_type("assinatura_auto", FRAME).alias("assinatura_auto"),
        dec.direction("sentido_trafego", FRAME).alias("sentido_trafego"),
        dec.foreign_flag("indicador_veiculo_estrangeiro").alias("indicador_veiculo_estrangeiro"),
        dec.plate_state("uf_placa", FRAME).alias("uf_placa"),
        dec.species("descricao_especie_veiculo", FRAME).alias("descricao_especie_veiculo"),
        dec.vehicle_type("descricao_tipo_veiculo", FRAME).alias("descricao_tipo_veiculo"),
        dec.make("descricao_marca_veiculo", FRAME).alias("descricao_marca_veiculo"),
        blank_default("descricao_modelo_veiculo").alias("descricao_modelo_veiculo"),
        blank_default("descricao_abreviada_infracao").alias("descricao_abreviada_infracao"),
        blank_default("enquadramento_infracao").alias("enquadramento_infracao"),
        P.frame_int("codigo_infracao", 0).alias("codigo_infracao"),
        P.km("km_infracao", FRAME).alias("km_infracao"),
        P.frame_int("qtd_infracoes", 1).alias("qtd_infracoes"),
        F.col("hora_infracao"),
        P.decimal_comma("medicao_considerada", FRAME).alias("medicao_considerada"),
        P.decimal_comma("excesso_verificado", FRAME).alias("excesso_verificado"),
        d.alias("data_infracao"),
        # the region is derived from the state before blanks are filled
        dec.region_for("uf_infracao", FRAME).alias("regiao_infracao"),
        *pos,
        *_raw_row(keep_raw),
    )
    if valid_only:
        typed = typed.filter(VALID)
    parts = cal.date_parts("data_infracao")
    return typed.select(
        *[F.col(c) for c in typed.columns],
        *[v.alias(k) for k, v in parts.items()],
        cal.is_holiday("data_infracao", holidays).alias("is_feriado"),
    ).select(*PREPARED_COLUMNS, "is_feriado", *([POSITION] if pos else []), *([RAW_ROW] if keep_raw else []))


def normalize(raw: DataFrame, rules: str = SQL, holidays: str = "listed") -> DataFrame:
    """Clean a RAW DataFrame (C1/C2).  Rows without an auto number or a valid date are dropped."""
    if rules == SQL:
        return normalize_sql(raw)
    if rules == FRAME:
        return normalize_frame(raw, holidays)
    raise ValueError(f"rules must be 'sql' or 'frame', got {rules!r}")


def typed(raw: DataFrame, rules: str = SQL, holidays: str = "listed", keep_raw: bool = False) -> DataFrame:
    """The cleaning projection over all rows, also those that ``normalize`` drops; ``keep_raw`` adds the 25 raw columns as a struct."""
    if rules == SQL:
        return normalize_sql(raw, valid_only=False, keep_raw=keep_raw)
    if rules == FRAME:
        return normalize_frame(raw, holidays, valid_only=False, keep_raw=keep_raw)
    raise ValueError(f"rules must be 'sql' or 'frame', got {rules!r}")
