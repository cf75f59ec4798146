"""Record shapes, value domains and declared feature views."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The domains the event schema declares.
# ---------------------------------------------------------------------------
PERSON_TYPES = ["FISICA", "JURIDICA"]
PURPOSES = ["CUSTEIO_SAFRA", "INVESTIMENTO_MAQUINARIO", "AMPLIACAO_AREA", "OUTROS"]
CROPS = [
    "SOJA", "MILHO", "CAFE", "CANA_DE_ACUCAR", "ALGODAO",
    "FRUTICULTURA", "TRIGO", "ARROZ", "FEIJAO", "EUCALIPTO",
]
PROPERTY_CLASSES = ["MINIFUNDIO", "PEQUENA", "MEDIA", "GRANDE"]
RISK_BANDS = ["SEM_SCORE", "MUITO_ALTO", "ALTO", "MEDIO", "BAIXO"]

# Money and area are exact decimals so that sums do not depend on row order.
MONEY = T.DecimalType(18, 2)
COORDINATE = T.DecimalType(18, 6)

_LOCATION = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("uf", T.StringType()),
    ]
)
_EXTERNAL = T.StructType(
    [
        T.StructField("serasa_score", T.IntegerType()),
        T.StructField("ibama_autuacoes_ativas", T.BooleanType()),
        T.StructField("numero_matricula_imovel", T.StringType()),
    ]
)
_METADATA = T.StructType(
    [
        T.StructField("versao_schema", T.StringType()),
        T.StructField("origem_dados", T.StringType()),
        T.StructField("timestamp_geracao_evento", T.LongType()),
    ]
)

# One credit application as it travels on the event stream (times in epoch ms).
APPLICATION = T.StructType(
    [
        T.StructField("proponente_id", T.StringType()),
        T.StructField("data_solicitacao", T.LongType()),
        T.StructField("cpf_cnpj", T.StringType()),
        T.StructField("nome_razao_social", T.StringType()),
        T.StructField("tipo_pessoa", T.StringType()),
        T.StructField("renda_bruta_anual_declarada", MONEY),
        T.StructField("valor_solicitado_credito", MONEY),
        T.StructField("finalidade_credito", T.StringType()),
        T.StructField("localizacao_propriedade", _LOCATION),
        T.StructField("area_total_hectares", MONEY),
        T.StructField("cultura_principal", T.StringType()),
        T.StructField("possui_experiencia_atividade", T.BooleanType()),
        T.StructField("anos_experiencia", T.IntegerType()),
        T.StructField("fontes_dados_adicionais", _EXTERNAL),
        T.StructField("metadata_evento", _METADATA),
    ]
)

BRONZE = T.StructType([*APPLICATION.fields, T.StructField("ingestion_timestamp", T.TimestampType())])

SILVER_KEY = ["proponente_id", "data_solicitacao", "valor_solicitado_credito"]
# Functions of the silver key, so that versions of a row stay together. The person type is
# left out: a corrected application may change it.
SILVER_PARTITIONS = ["ano", "mes"]
APPLICANT_KEY = ["proponente_id"]
LOCATION_KEY = ["localizacao_uf", "localizacao_municipio"]
RISK_KEY = ["faixa_risco_credito", "cultura_principal"]

# The model inputs, in the order the scorer expects them.
MODEL_FEATURES = [
    "total_solicitacoes",
    "valor_total_solicitado",
    "valor_medio_solicitado",
    "valor_maximo_solicitado",
    "valor_minimo_solicitado",
    "serasa_score_medio",
    "anos_experiencia_medio",
    "area_media_hectares",
    "taxa_autuacoes_ibama",
    "diversidade_culturas",
    "diversidade_finalidades",
]

# The features watched for drift.
DRIFT_FEATURES = [
    "valor_total_solicitado",
    "valor_medio_solicitado",
    "area_media_hectares",
    "anos_experiencia_medio",
    "serasa_score_medio",
]


@dataclass(frozen=True)
class FeatureView:
    """A served slice of a gold table: entity key, freshness limit and fields."""

    name: str
    key: str
    ttl: timedelta
    fields: tuple[str, ...]
    timestamp: str = "feature_timestamp"


# Entity keys, time-to-live and fields of the served views.
PROPONENTE_VIEW = FeatureView(
    "proponente_features",
    "proponente_id",
    timedelta(days=30),
    (
        "total_solicitacoes",
        "valor_total_solicitado",
        "valor_medio_solicitado",
        "serasa_score_medio",
        "anos_experiencia_medio",
        "area_media_hectares",
    ),
)
LOCATION_VIEW = FeatureView(
    "location_features",
    "localizacao_key",
    timedelta(days=7),
    (
        "total_proponentes",
        "valor_total_solicitado",
        "valor_medio_solicitado",
        "area_total_hectares",
        "serasa_score_medio",
    ),
)
RISK_VIEW = FeatureView(
    "risk_features",
    "risco_cultura_key",
    timedelta(days=14),
    (
        "total_solicitacoes",
        "valor_total_solicitado",
        "valor_medio_solicitado",
        "area_total_hectares",
        "serasa_score_medio",
    ),
)
