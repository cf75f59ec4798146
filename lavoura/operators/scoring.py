"""Credit decisions for whole tables or streams of requests."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.columns import clamp, document_is_valid, flag, ladder, ratio
from ..schemas import MODEL_FEATURES

# Points of the rule score.
RATIO_POINTS = [(5, 0.2), (3, 0.1)]
EXPERIENCE_POINTS = [(10, 0.1), (5, 0.05)]
AREA_POINTS = [(500, 0.1), (100, 0.05)]
BUREAU_POINTS = [(700, 0.2), (500, 0.1)]


def rule_score() -> Column:
    """Additive score in 0..1; a part that is missing adds nothing."""
    income_ratio = ratio(F.col("renda_bruta_anual_declarada"), F.col("valor_solicitado_credito"))
    years, bureau = F.col("anos_experiencia"), F.col("serasa_score")
    by_ratio = ladder(income_ratio, operator.gt, RATIO_POINTS, None)
    by_experience = ladder(years, operator.gt, EXPERIENCE_POINTS, None)
    by_bureau = ladder(bureau, operator.gt, BUREAU_POINTS, -0.1)
    total = (
        F.lit(0.5)
        + F.coalesce(by_ratio, F.when(income_ratio < 1, -0.3), F.lit(0.0))
        + F.coalesce(by_experience, F.when(years == 0, -0.2), F.lit(0.0))
        + ladder(F.col("area_total_hectares"), operator.gt, AREA_POINTS, 0.0)
        + F.when(bureau.isNull() | (bureau == 0), 0.0).otherwise(by_bureau)
        - F.when(F.col("ibama_autuacoes_ativas"), 0.15).otherwise(0.0)
    )
    return clamp(total, 0.0, 1.0)


def credit_limit(score: Column) -> Column:
    """Up to 30% of income or the amount asked, scaled by the score."""
    base = F.least(
        F.col("valor_solicitado_credito").cast("double"), F.col("renda_bruta_anual_declarada").cast("double") * 0.3
    )
    return base * (F.lit(0.5) + score * 0.5)


def decide(requests: DataFrame, score: Column | None = None) -> DataFrame:
    """Append score, level, limit and recommendation; ``score`` defaults to the rules."""
    value = F.col("score")
    return requests.withColumn("score", rule_score() if score is None else score).withColumns(
        {
            "risk_level": classify.risk_level(value),
            "credit_limit": credit_limit(value),
            "recommendation": classify.recommendation(value),
            "approved_in_ui": classify.shown_as_approved(value),
        }
    )


def model_or_rules(default_probability: Column) -> Column:
    """Safety according to the model, or the rule score where the model gave nothing usable."""
    usable = default_probability.isNotNull() & ~F.isnan(default_probability) & default_probability.between(0, 1)
    return F.when(usable, 1 - default_probability).otherwise(rule_score())


def request_features() -> dict[str, Column]:
    """Features taken from the request itself."""
    c = F.col
    bureau = c("serasa_score")
    return {
        "renda_bruta_anual_declarada": c("renda_bruta_anual_declarada").cast("double"),
        "valor_solicitado_credito": c("valor_solicitado_credito").cast("double"),
        "area_total_hectares": c("area_total_hectares").cast("double"),
        "anos_experiencia": c("anos_experiencia"),
        "possui_experiencia_atividade": flag(c("possui_experiencia_atividade")),
        "tipo_pessoa_fisica": flag(c("tipo_pessoa") == "FISICA"),
        "serasa_score": F.when(bureau.isNull() | (bureau == 0), 500).otherwise(bureau),
        "ibama_autuacoes_ativas": flag(c("ibama_autuacoes_ativas")),
        "cultura_principal_soja": flag(c("cultura_principal") == "SOJA"),
        "cultura_principal_milho": flag(c("cultura_principal") == "MILHO"),
        "finalidade_custeio": flag(c("finalidade_credito") == "CUSTEIO_SAFRA"),
        "finalidade_investimento": flag(c("finalidade_credito") == "INVESTIMENTO_MAQUINARIO"),
    }


def with_request_features(requests: DataFrame, keep: list[str]) -> DataFrame:
    return requests.select(*keep, *[value.alias(name) for name, value in request_features().items()])


def feature_vector(features: DataFrame, keep: list[str]) -> DataFrame:
    """The model inputs in their fixed order, 0 where missing."""
    present = set(features.columns)
    return features.select(
        *keep,
        *[
            (F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in present else F.lit(0.0)).alias(name)
            for name in MODEL_FEATURES
        ],
    )


def validate_requests(requests: DataFrame) -> DataFrame:
    """Append ``is_valid`` and the first ``reason`` a request is refused for."""

    def empty(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name) == "")

    reason = (
        F.when(empty("proponente_id"), "missing_proponente_id")
        .when(~document_is_valid(F.col("cpf_cnpj")), "invalid_cpf_cnpj")
        .when(empty("nome_razao_social"), "missing_nome_razao_social")
        .when(empty("localizacao_municipio"), "missing_municipio")
        .when(empty("numero_matricula_imovel"), "missing_numero_matricula")
    )
    return requests.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())
