"""Small hand-made tables for the edge cases."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from lavoura.schemas import BRONZE

NOON = datetime(2024, 1, 8, 12, 0, tzinfo=timezone.utc)
MS = int(NOON.timestamp() * 1000)


def bronze_row(**changes):
    """One complete bronze row; nested fields are addressed by their own names."""
    row = {
        "proponente_id": "PROP_00001",
        "data_solicitacao": MS,
        "cpf_cnpj": "00000000001",
        "nome_razao_social": "Produtor 1",
        "tipo_pessoa": "FISICA",
        "renda_bruta_anual_declarada": Decimal("100000.00"),
        "valor_solicitado_credito": Decimal("50000.00"),
        "finalidade_credito": "CUSTEIO_SAFRA",
        "latitude": -20.0,
        "longitude": -50.0,
        "municipio": "Campo Grande",
        "uf": "MS",
        "area_total_hectares": Decimal("100.00"),
        "cultura_principal": "SOJA",
        "possui_experiencia_atividade": True,
        "anos_experiencia": 8,
        "serasa_score": 650,
        "ibama_autuacoes_ativas": False,
        "numero_matricula_imovel": "MAT-000001",
        "versao_schema": "1.0.0",
        "origem_dados": "test",
        "timestamp_geracao_evento": MS,
        "ingestion_timestamp": NOON,
    }
    unknown = set(changes) - set(row)
    assert not unknown, unknown
    row.update(changes)
    for name in ("renda_bruta_anual_declarada", "valor_solicitado_credito", "area_total_hectares"):
        if row[name] is not None:
            row[name] = Decimal(str(row[name])).quantize(Decimal("0.01"))
    return (
        row["proponente_id"],
        row["data_solicitacao"],
        row["cpf_cnpj"],
        row["nome_razao_social"],
        row["tipo_pessoa"],
        row["renda_bruta_anual_declarada"],
        row["valor_solicitado_credito"],
        row["finalidade_credito"],
        (row["latitude"], row["longitude"], row["municipio"], row["uf"]),
        row["area_total_hectares"],
        row["cultura_principal"],
        row["possui_experiencia_atividade"],
        row["anos_experiencia"],
        (row["serasa_score"], row["ibama_autuacoes_ativas"], row["numero_matricula_imovel"]),
        (row["versao_schema"], row["origem_dados"], row["timestamp_geracao_evento"]),
        row["ingestion_timestamp"],
    )


def bronze(spark, *changes):
    return spark.createDataFrame([bronze_row(**c) for c in changes], BRONZE)
