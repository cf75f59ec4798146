"""Gold feature tables: by applicant, by place, and by risk band and crop.

Every table is one aggregate of valid silver rows, with map-side partial results. The
tables that count identifiers per group get those from a second, narrow aggregate.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.columns import (
    composite_key,
    coordinate_mean,
    exact_mean,
    instant,
    is_blank,
    ratio,
    share,
    spread,
    whole_days,
)
from ..schemas import APPLICANT_KEY, LOCATION_KEY, RISK_KEY
from ..sources.staging import staged
from .categories import count_identifiers, kinds, most_common
from .incremental import upsert
from .quantiles import exact_percentiles

# Rank error of the approximate percentiles is one in this many rows. Every map task sends
# a sketch of about this size for each group, so a hot group's sketches stay mergeable.
PERCENTILE_ACCURACY = 10_000

# The silver columns the gold tables are built from.
SILVER_INPUTS = [
    "proponente_id", "data_solicitacao", "tipo_pessoa", "valor_solicitado_credito", "finalidade_credito", "localizacao_latitude",
    "localizacao_longitude", "localizacao_municipio", "localizacao_uf", "area_total_hectares", "cultura_principal",
    "anos_experiencia", "serasa_score", "ibama_autuacoes_ativas", "classificacao_propriedade", "faixa_risco_credito",
    "registro_valido", "processed_at",
]


def usable_rows(silver: DataFrame, keys: list[str]) -> DataFrame:
    """Valid rows whose group keys are present and not blank."""
    rows = silver.where(F.col("registro_valido"))
    for key in keys:
        rows = rows.where(~is_blank(F.col(key)))
    return rows


def _money(name: str) -> Column:
    return F.sum(name).cast("double")


def _equals_share(column: str, value) -> Column:
    return share(F.col(column) == F.lit(value))


def _fine_rate() -> Column:
    return share(F.col("ibama_autuacoes_ativas"))


def _request_span() -> list[Column]:
    return [F.max("data_solicitacao").alias("ultima_solicitacao"), F.min("data_solicitacao").alias("primeira_solicitacao")]


def _with_identifiers(measures: DataFrame, rows: DataFrame, keys: list[str], counts: dict[str, str]) -> DataFrame:
    """Measures with distinct identifiers counted; a group without any counts zero."""
    return measures.join(count_identifiers(rows, keys, counts), keys, "left").fillna(0, subset=list(counts))


def gold_proponente(silver: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Features per applicant."""
    rows = usable_rows(silver, APPLICANT_KEY)
    measures = rows.groupBy(*APPLICANT_KEY).agg(
        F.count(F.lit(1)).alias("total_solicitacoes"),
        _money("valor_solicitado_credito").alias("valor_total_solicitado"),
        exact_mean(F.col("valor_solicitado_credito")).alias("valor_medio_solicitado"),
        F.max("valor_solicitado_credito").cast("double").alias("valor_maximo_solicitado"),
        F.min("valor_solicitado_credito").cast("double").alias("valor_minimo_solicitado"),
        spread(F.col("valor_solicitado_credito")).alias("valor_desvio_padrao"),
        *_request_span(),
        exact_mean(F.col("serasa_score")).alias("serasa_score_medio"),
        F.max("serasa_score").alias("serasa_score_maximo"),
        F.min("serasa_score").alias("serasa_score_minimo"),
        coordinate_mean(F.col("localizacao_latitude")).alias("latitude_media"),
        coordinate_mean(F.col("localizacao_longitude")).alias("longitude_media"),
        exact_mean(F.col("area_total_hectares")).alias("area_media_hectares"),
        exact_mean(F.col("anos_experiencia")).alias("anos_experiencia_medio"),
        F.max("anos_experiencia").alias("anos_experiencia_maximo"),
        _fine_rate().alias("taxa_autuacoes_ibama"),
        most_common("finalidade_credito").alias("finalidade_mais_comum"),
        most_common("cultura_principal").alias("cultura_mais_comum"),
        most_common("classificacao_propriedade").alias("classificacao_mais_comum"),
        most_common("faixa_risco_credito").alias("faixa_risco_mais_comum"),
        kinds("finalidade_credito").alias("diversidade_finalidades"),
        kinds("cultura_principal").alias("diversidade_culturas"),
        kinds("localizacao_uf").alias("diversidade_ufs"),
        F.max("processed_at").alias("ultima_atualizacao"),
    )
    return proponente_features(measures, as_of)


def proponente_features(measures: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """The table by applicant from its measures."""
    sd, mean = F.col("valor_desvio_padrao"), F.col("valor_medio_solicitado")
    return measures.select(
        "proponente_id",
        "total_solicitacoes",
        "valor_total_solicitado",
        "valor_medio_solicitado",
        "valor_maximo_solicitado",
        "valor_minimo_solicitado",
        "valor_desvio_padrao",
        whole_days(F.col("primeira_solicitacao"), F.col("ultima_solicitacao")).alias("dias_entre_primeira_ultima"),
        "serasa_score_medio",
        "serasa_score_maximo",
        "serasa_score_minimo",
        "latitude_media",
        "longitude_media",
        "area_media_hectares",
        "diversidade_finalidades",
        "diversidade_culturas",
        "diversidade_ufs",
        "anos_experiencia_medio",
        "anos_experiencia_maximo",
        "taxa_autuacoes_ibama",
        classify.score_risk(F.col("serasa_score_medio")).alias("indicador_risco_score"),
        classify.environmental_risk(F.col("taxa_autuacoes_ibama")).alias("indicador_risco_ambiental"),
        ratio(F.col("valor_total_solicitado"), F.col("area_media_hectares")).alias("valor_por_hectare"),
        F.month("ultima_solicitacao").alias("mes_ultima_solicitacao"),
        F.quarter("ultima_solicitacao").alias("trimestre_ultima_solicitacao"),
        "finalidade_mais_comum",
        "cultura_mais_comum",
        "classificacao_mais_comum",
        "faixa_risco_mais_comum",
        classify.frequency_profile(F.col("total_solicitacoes")).alias("perfil_frequencia"),
        classify.volatility_profile(sd, mean).alias("perfil_volatilidade"),
        classify.diversification_profile(F.col("diversidade_finalidades")).alias("perfil_diversificacao"),
        "ultima_solicitacao",
        "primeira_solicitacao",
        instant(as_of).alias("feature_timestamp"),
        "ultima_atualizacao",
    )


def _percentiles(column: str, probabilities: dict[str, float]) -> list[Column]:
    """Percentiles of a sketch: off by one rank in PERCENTILE_ACCURACY at most. Only where asked for."""
    sketch = F.percentile_approx(column, list(probabilities.values()), PERCENTILE_ACCURACY)
    return [sketch[i].cast("double").alias(name) for i, name in enumerate(probabilities)]


def _with_percentiles(measures: DataFrame, rows: DataFrame, keys: list[str], probabilities: dict[str, float], exact: bool) -> DataFrame:
    """Swap the sketched percentiles for exact ones, unless the sketch is wanted."""
    if not exact:
        return measures
    found = exact_percentiles(rows, keys, "valor_solicitado_credito", probabilities)
    found = found.select(*keys, *[F.col(name).cast("double").alias(name) for name in probabilities])
    return measures.drop(*probabilities).join(found, keys, "left")


def gold_location(silver: DataFrame, as_of: datetime | str | Column, exact: bool = True) -> DataFrame:
    """Features per state and municipality."""
    rows = usable_rows(silver, LOCATION_KEY)
    median = {"valor_mediano_solicitado": 0.5}
    zero = F.lit(0.0)
    measures = rows.groupBy(*LOCATION_KEY).agg(
        F.count(F.lit(1)).alias("total_proponentes"),
        _money("valor_solicitado_credito").alias("valor_total_solicitado"),
        exact_mean(F.col("valor_solicitado_credito")).alias("valor_medio_solicitado"),
        F.coalesce(spread(F.col("valor_solicitado_credito")), zero).alias("valor_desvio_padrao"),
        *_percentiles("valor_solicitado_credito", median),
        F.sum("area_total_hectares").cast("double").alias("area_total_hectares"),
        exact_mean(F.col("area_total_hectares")).alias("area_media_hectares"),
        F.coalesce(spread(F.col("area_total_hectares")), zero).alias("area_desvio_padrao"),
        coordinate_mean(F.col("localizacao_latitude")).alias("latitude_media"),
        coordinate_mean(F.col("localizacao_longitude")).alias("longitude_media"),
        F.coalesce(spread(F.col("localizacao_latitude")), zero).alias("latitude_desvio_padrao"),
        F.coalesce(spread(F.col("localizacao_longitude")), zero).alias("longitude_desvio_padrao"),
        F.coalesce(exact_mean(F.col("serasa_score")), zero).alias("serasa_score_medio"),
        F.coalesce(spread(F.col("serasa_score")), zero).alias("serasa_score_desvio_padrao"),
        exact_mean(F.col("anos_experiencia")).alias("anos_experiencia_medio"),
        _fine_rate().alias("taxa_autuacoes_ibama"),
        *_request_span(),
        _equals_share("faixa_risco_credito", "BAIXO").alias("taxa_risco_baixo"),
        _equals_share("faixa_risco_credito", "MEDIO").alias("taxa_risco_medio"),
        _equals_share("faixa_risco_credito", "ALTO").alias("taxa_risco_alto"),
        _equals_share("faixa_risco_credito", "MUITO_ALTO").alias("taxa_risco_muito_alto"),
        _equals_share("tipo_pessoa", "JURIDICA").alias("taxa_pessoa_juridica"),
        most_common("cultura_principal").alias("cultura_dominante"),
        most_common("finalidade_credito").alias("finalidade_dominante"),
        most_common("classificacao_propriedade").alias("classificacao_dominante"),
        kinds("cultura_principal").alias("diversidade_culturas"),
        kinds("finalidade_credito").alias("diversidade_finalidades"),
        kinds("classificacao_propriedade").alias("diversidade_classificacoes"),
        F.max("processed_at").alias("ultima_atualizacao"),
    )
    measures = _with_percentiles(measures, rows, LOCATION_KEY, median, exact)
    return location_features(_with_identifiers(measures, rows, LOCATION_KEY, {"proponentes_unicos": "proponente_id"}), as_of)


def location_features(measures: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """The table by place from its measures."""
    sd, mean = F.col("valor_desvio_padrao"), F.col("valor_medio_solicitado")
    return measures.select(
        *LOCATION_KEY,
        composite_key(*[F.col(k) for k in LOCATION_KEY]).alias("localizacao_key"),
        "total_proponentes",
        "proponentes_unicos",
        "valor_total_solicitado",
        "valor_medio_solicitado",
        "valor_desvio_padrao",
        "valor_mediano_solicitado",
        "area_total_hectares",
        "area_media_hectares",
        "area_desvio_padrao",
        "latitude_media",
        "longitude_media",
        "latitude_desvio_padrao",
        "longitude_desvio_padrao",
        "serasa_score_medio",
        "serasa_score_desvio_padrao",
        "anos_experiencia_medio",
        "diversidade_culturas",
        "diversidade_finalidades",
        "diversidade_classificacoes",
        "taxa_autuacoes_ibama",
        "taxa_risco_baixo",
        "taxa_risco_medio",
        "taxa_risco_alto",
        "taxa_risco_muito_alto",
        "taxa_pessoa_juridica",
        ratio(F.col("valor_total_solicitado"), F.col("area_total_hectares")).alias("intensidade_credito_por_hectare"),
        ratio(F.col("proponentes_unicos"), F.col("total_proponentes")).alias("taxa_recorrencia"),
        (F.col("taxa_risco_alto") + F.col("taxa_risco_muito_alto")).alias("taxa_risco_elevado"),
        "cultura_dominante",
        "finalidade_dominante",
        "classificacao_dominante",
        classify.density(F.col("total_proponentes")).alias("densidade_proponentes"),
        classify.credit_homogeneity(sd, mean).alias("homogeneidade_credito"),
        classify.crop_diversification(F.col("diversidade_culturas")).alias("perfil_diversificacao_culturas"),
        classify.region(F.col("latitude_media")).alias("regiao_geografica"),
        "ultima_solicitacao",
        "primeira_solicitacao",
        instant(as_of).alias("feature_timestamp"),
        "ultima_atualizacao",
    )


def gold_risk(silver: DataFrame, as_of: datetime | str | Column, exact: bool = True) -> DataFrame:
    """Features per risk band and main crop."""
    rows = usable_rows(silver, RISK_KEY)
    levels = {"valor_p25": 0.25, "valor_mediano": 0.5, "valor_p75": 0.75, "valor_p90": 0.9}
    measures = rows.groupBy(*RISK_KEY).agg(
        F.count(F.lit(1)).alias("total_solicitacoes"),
        _money("valor_solicitado_credito").alias("valor_total_solicitado"),
        exact_mean(F.col("valor_solicitado_credito")).alias("valor_medio_solicitado"),
        spread(F.col("valor_solicitado_credito")).alias("valor_desvio_padrao"),
        *_percentiles("valor_solicitado_credito", levels),
        F.sum("area_total_hectares").cast("double").alias("area_total_hectares"),
        exact_mean(F.col("area_total_hectares")).alias("area_media_hectares"),
        spread(F.col("area_total_hectares")).alias("area_desvio_padrao"),
        exact_mean(F.col("serasa_score")).alias("serasa_score_medio"),
        spread(F.col("serasa_score")).alias("serasa_score_desvio_padrao"),
        F.min("serasa_score").alias("serasa_score_minimo"),
        F.max("serasa_score").alias("serasa_score_maximo"),
        exact_mean(F.col("anos_experiencia")).alias("anos_experiencia_medio"),
        spread(F.col("anos_experiencia")).alias("anos_experiencia_desvio_padrao"),
        _equals_share("tipo_pessoa", "JURIDICA").alias("taxa_pessoa_juridica"),
        _equals_share("classificacao_propriedade", "MINIFUNDIO").alias("taxa_minifundio"),
        _equals_share("classificacao_propriedade", "PEQUENA").alias("taxa_pequena"),
        _equals_share("classificacao_propriedade", "MEDIA").alias("taxa_media"),
        _equals_share("classificacao_propriedade", "GRANDE").alias("taxa_grande"),
        _equals_share("finalidade_credito", "CUSTEIO_SAFRA").alias("taxa_custeio_safra"),
        _equals_share("finalidade_credito", "INVESTIMENTO_MAQUINARIO").alias("taxa_investimento_maquinario"),
        _equals_share("finalidade_credito", "AMPLIACAO_AREA").alias("taxa_ampliacao_area"),
        _fine_rate().alias("taxa_autuacoes_ibama"),
        *_request_span(),
        kinds("localizacao_uf").alias("diversidade_ufs"),
        F.max("processed_at").alias("ultima_atualizacao"),
    )
    measures = _with_percentiles(measures, rows, RISK_KEY, levels, exact)
    identifiers = {"proponentes_unicos": "proponente_id", "diversidade_municipios": "localizacao_municipio"}
    return risk_features(_with_identifiers(measures, rows, RISK_KEY, identifiers), as_of)


def risk_features(measures: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """The table by risk band and crop from its measures."""
    levels = ["valor_p25", "valor_mediano", "valor_p75", "valor_p90"]
    sd, mean = F.col("valor_desvio_padrao"), F.col("valor_medio_solicitado")
    band, crop = F.col("faixa_risco_credito"), F.col("cultura_principal")
    return measures.select(
        *RISK_KEY,
        composite_key(band, crop).alias("risco_cultura_key"),
        "total_solicitacoes",
        "proponentes_unicos",
        "valor_total_solicitado",
        "valor_medio_solicitado",
        "valor_desvio_padrao",
        *levels,
        "area_total_hectares",
        "area_media_hectares",
        "area_desvio_padrao",
        "serasa_score_medio",
        "serasa_score_desvio_padrao",
        "serasa_score_minimo",
        "serasa_score_maximo",
        "anos_experiencia_medio",
        "anos_experiencia_desvio_padrao",
        "taxa_pessoa_juridica",
        "taxa_minifundio",
        "taxa_pequena",
        "taxa_media",
        "taxa_grande",
        "taxa_custeio_safra",
        "taxa_investimento_maquinario",
        "taxa_ampliacao_area",
        "taxa_autuacoes_ibama",
        "diversidade_ufs",
        "diversidade_municipios",
        classify.band_weight(band).alias("peso_risco_base"),
        classify.crop_factor(crop).alias("fator_risco_cultura"),
        ratio(F.col("valor_total_solicitado"), F.col("area_total_hectares")).alias("intensidade_credito_por_hectare"),
        ratio(F.col("proponentes_unicos"), F.col("total_solicitacoes")).alias("taxa_recorrencia"),
        classify.adjusted_risk(band, crop, F.col("taxa_autuacoes_ibama")).alias("score_risco_ajustado"),
        classify.volume(F.col("total_solicitacoes")).alias("volume_solicitacoes"),
        classify.credit_volatility(sd, mean).alias("volatilidade_credito"),
        classify.person_profile(F.col("taxa_pessoa_juridica")).alias("perfil_tipo_pessoa"),
        classify.purpose_profile(
            F.col("taxa_custeio_safra"), F.col("taxa_investimento_maquinario"), F.col("taxa_ampliacao_area")
        ).alias("perfil_finalidade"),
        "ultima_solicitacao",
        "primeira_solicitacao",
        instant(as_of).alias("feature_timestamp"),
        "ultima_atualizacao",
    )


MODELS = {
    "proponente": (gold_proponente, APPLICANT_KEY),
    "location": (gold_location, LOCATION_KEY),
    "risk": (gold_risk, RISK_KEY),
}
FINISH = {"proponente": proponente_features, "location": location_features, "risk": risk_features}


def refresh(
    model: str, silver: DataFrame, gold: DataFrame, since: datetime | str | Column, as_of: datetime | str | Column,
    scope: str = "history", changed: DataFrame | None = None,
) -> DataFrame:
    """Gold after silver rows came in.

    ``scope="history"`` recomputes every touched key from all its rows and drops keys that
    have none left, so the result equals a full build. Touched are the keys of ``changed``,
    which must hold replaced versions of rows as well as new ones, valid or not; without it,
    those of the rows processed at ``since`` or later, which is enough where rows only come in.
    ``scope="increment"`` aggregates the rows processed after ``since`` alone and replaces the
    keys' rows with that. It goes by time stamps and ignores ``changed``: rows stamped before
    ``since`` and committed after the last refresh are lost to it.
    """
    build, keys = MODELS[model]
    if scope == "increment":
        return upsert(gold, build(silver.where(F.col("processed_at") > instant(since)), as_of), keys, ["feature_timestamp"])
    rows = silver.where(F.col("processed_at") >= instant(since)) if changed is None else changed
    touched = staged(rows.select(*keys).distinct(), "changed")
    rebuilt = build(silver.join(touched, keys, "left_semi"), as_of)
    return gold.join(touched, keys, "left_anti").unionByName(rebuilt)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total_features")) for name, df in tables.items()]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total
