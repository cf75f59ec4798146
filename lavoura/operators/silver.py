"""Silver: bronze applications flattened, typed, classified, validated and hashed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.columns import instant, millis_to_instant, struct_field
from .incremental import newer_than


def flatten(bronze: DataFrame) -> DataFrame:
    """Identified applications with struct fields lifted out and times as instants."""
    return bronze.where(F.col("proponente_id").isNotNull()).select(
        "proponente_id",
        millis_to_instant(F.col("data_solicitacao")).alias("data_solicitacao"),
        "cpf_cnpj",
        "nome_razao_social",
        "tipo_pessoa",
        "renda_bruta_anual_declarada",
        "valor_solicitado_credito",
        "finalidade_credito",
        struct_field("localizacao_propriedade", "latitude", "double").alias("localizacao_latitude"),
        struct_field("localizacao_propriedade", "longitude", "double").alias("localizacao_longitude"),
        struct_field("localizacao_propriedade", "municipio").alias("localizacao_municipio"),
        struct_field("localizacao_propriedade", "uf").alias("localizacao_uf"),
        "area_total_hectares",
        "cultura_principal",
        "possui_experiencia_atividade",
        "anos_experiencia",
        struct_field("fontes_dados_adicionais", "serasa_score", "int").alias("serasa_score"),
        struct_field("fontes_dados_adicionais", "ibama_autuacoes_ativas", "boolean").alias("ibama_autuacoes_ativas"),
        struct_field("fontes_dados_adicionais", "numero_matricula_imovel").alias("numero_matricula_imovel"),
        struct_field("metadata_evento", "versao_schema").alias("versao_schema"),
        struct_field("metadata_evento", "origem_dados").alias("origem_dados"),
        millis_to_instant(F.col("metadata_evento.timestamp_geracao_evento")).alias("timestamp_geracao_evento"),
        "ingestion_timestamp",
    )


def row_hash() -> Column:
    """Change-detection hash over identity, request time in epoch ms, value, area and state."""
    parts = [
        F.col("proponente_id"),
        F.unix_millis("data_solicitacao").cast("string"),
        F.col("valor_solicitado_credito").cast("string"),
        F.col("area_total_hectares").cast("string"),
        F.col("localizacao_uf"),
    ]
    return F.upper(F.md5(F.concat(*[F.coalesce(p, F.lit("")) for p in parts])))


def classify_rows(flat: DataFrame) -> DataFrame:
    """Append property class, risk band and the validity flag."""
    return flat.withColumns(
        {
            "classificacao_propriedade": classify.property_class(F.col("area_total_hectares")),
            "faixa_risco_credito": classify.risk_band(F.col("serasa_score")),
            "registro_valido": classify.is_valid(
                F.col("cpf_cnpj"),
                F.col("valor_solicitado_credito"),
                F.col("area_total_hectares"),
                F.col("localizacao_uf"),
            ),
        }
    )


def build_silver(bronze: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """The silver table for these bronze rows, one pass and no shuffle."""
    return classify_rows(flatten(bronze)).withColumns({"processed_at": instant(as_of), "row_hash": row_hash()})


def silver_increment(bronze: DataFrame, silver: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Silver rows for bronze that arrived after everything silver holds."""
    return build_silver(newer_than(bronze, silver, "ingestion_timestamp"), as_of)
