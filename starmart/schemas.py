"""Table layouts of the warehouse.

The raw landing table is fixed and untyped (25 nullable strings); typing
happens in the normalisation step.  Star tables are fixed by projection.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The 25 source columns, as (storage name, source header),
# in source order.  Headers must equal the published file layout.
# ---------------------------------------------------------------------------
RAW_COLUMNS_AND_HEADERS: list[tuple[str, str]] = [
    ("numero_auto", "Número do Auto"),
    ("data_infracao", "Data da Infração (DD/MM/AAAA)"),
    ("indicador_abordagem", "Indicador de Abordagem"),
    ("assinatura_auto", "Assinatura do Auto"),
    ("sentido_trafego", "Sentido Tráfego"),
    ("uf_infracao", "UF Infração"),
    ("br_infracao", "BR Infração"),
    ("km_infracao", "Km Infração"),
    ("municipio", "Município"),
    ("indicador_veiculo_estrangeiro", "Indicador Veículo Estrangeiro"),
    ("uf_placa", "UF Placa"),
    ("descricao_especie_veiculo", "Descrição Espécie Veículo"),
    ("descricao_marca_veiculo", "Descrição Marca Veículo"),
    ("descricao_tipo_veiculo", "Descrição Tipo Veículo"),
    ("descricao_modelo_veiculo", "Descrição Modelo Veículo"),
    ("codigo_infracao", "Código da Infração"),
    ("descricao_abreviada_infracao", "Descrição Abreviada Infração"),
    ("enquadramento_infracao", "Enquadramento da Infração"),
    ("inicio_vigencia_infracao", "Início Vigência da Infração"),
    ("fim_vigencia_infracao", "Fim Vigência Infração"),
    ("medicao_infracao", "Medição Infração"),
    ("hora_infracao", "Hora Infração"),
    ("medicao_considerada", "Medição Considerada"),
    ("excesso_verificado", "Excesso Verificado"),
    ("qtd_infracoes", "Qtd Infrações"),
]

RAW_COLUMNS: list[str] = [name for name, _ in RAW_COLUMNS_AND_HEADERS]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# ---------------------------------------------------------------------------
# Columns of the cleaned table, in published order.
# ---------------------------------------------------------------------------
PREPARED_COLUMNS = [
    "numero_auto",
    "uf_infracao",
    "municipio",
    "indicador_abordagem",
    "br_infracao",
    "assinatura_auto",
    "sentido_trafego",
    "indicador_veiculo_estrangeiro",
    "uf_placa",
    "descricao_especie_veiculo",
    "descricao_tipo_veiculo",
    "descricao_marca_veiculo",
    "descricao_modelo_veiculo",
    "descricao_abreviada_infracao",
    "enquadramento_infracao",
    "codigo_infracao",
    "km_infracao",
    "qtd_infracoes",
    "hora_infracao",
    "medicao_considerada",
    "excesso_verificado",
    "data_infracao",
    "dia",
    "mes",
    "ano",
    "trimestre",
    "dia_semana",
    "regiao_infracao",
]

# Columns of each dimension's natural key, in key order.
TIME_KEY = ["data_infracao"]
LOCATION_KEY = ["uf_infracao", "br_infracao", "km_infracao", "municipio", "regiao_infracao", "sentido_trafego"]
OFFENCE_KEY = ["codigo_infracao"]
OFFENDER_KEY = [
    "indicador_veiculo_estrangeiro",
    "uf_placa",
    "descricao_especie_veiculo",
    "descricao_marca_veiculo",
    "descricao_tipo_veiculo",
    "descricao_modelo_veiculo",
    "indicador_abordagem",
    "assinatura_auto",
]

# Surrogate-key names.
TIME_SK = "id_tempo_sk"
LOCATION_SK = "id_localizacao_sk"
OFFENCE_SK = "id_infracao_sk"
OFFENDER_SK = "id_infrator_sk"

FACT_MEASURES = ["numero_auto", "qtd_infracoes", "medicao_considerada", "excesso_verificado"]
# Degenerate attributes the SQL preset keeps on the fact.
FACT_EXTRA_SQL = ["indicador_abordagem", "assinatura_auto", "sentido_trafego"]
