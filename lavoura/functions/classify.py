"""Business classifications. Order matters; NULL takes the last result unless tested first."""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ladder, ratio

# ---------------------------------------------------------------------------
# Class limits, labels and weights.
# ---------------------------------------------------------------------------
AREA_LIMITS = [(50, "MINIFUNDIO"), (200, "PEQUENA"), (1000, "MEDIA")]
SCORE_LIMITS = [(700, "BAIXO"), (500, "MEDIO"), (300, "ALTO")]
FREQUENCY_LIMITS = [(1, "NOVO"), (5, "RECORRENTE"), (10, "FREQUENTE")]
PURPOSE_COUNT_LIMITS = [(2, "FOCADO")]
CROP_COUNT_LIMITS = [(3, "POUCO_DIVERSIFICADA"), (5, "MODERADAMENTE_DIVERSIFICADA")]
SCORE_RISK_LIMITS = [(300, 1.0), (500, 0.8), (700, 0.6)]
FINE_RISK_LIMITS = [(0.5, 1.0), (0.2, 0.8), (0.0, 0.6)]
DENSITY_LIMITS = [(10, "BAIXA"), (50, "MEDIA"), (200, "ALTA")]
VOLUME_LIMITS = [(10, "BAIXO_VOLUME"), (50, "MEDIO_VOLUME"), (200, "ALTO_VOLUME")]
LATITUDE_LIMITS = [(-10, "NORTE"), (-20, "NORDESTE"), (-30, "CENTRO_OESTE_SUDESTE")]
COMPANY_LIMITS = [(0.7, "PREDOMINANTEMENTE_JURIDICA"), (0.3, "MISTA")]
BAND_WEIGHTS = [("BAIXO", 0.1), ("MEDIO", 0.3), ("ALTO", 0.6), ("MUITO_ALTO", 0.9)]
CROP_FACTORS = [
    ("SOJA", 0.9), ("MILHO", 0.9), ("CAFE", 0.9),
    ("CANA_DE_ACUCAR", 1.0), ("ALGODAO", 1.0),
    ("FRUTICULTURA", 1.1), ("TRIGO", 1.1),
]
FINE_FACTORS = [(0.3, 1.2), (0.1, 1.1)]
LEVEL_LIMITS = [(0.7, "LOW"), (0.4, "MEDIUM")]
DECISION_LIMITS = [(0.6, "APPROVE"), (0.3, "MANUAL_REVIEW")]


def property_class(area: Column) -> Column:
    return ladder(area, operator.lt, AREA_LIMITS, "GRANDE")


def risk_band(score: Column) -> Column:
    return F.when(score.isNull(), "SEM_SCORE").otherwise(ladder(score, operator.ge, SCORE_LIMITS, "MUITO_ALTO"))


def is_valid(document: Column, value: Column, area: Column, state: Column) -> Column:
    """Never NULL: an unknown part makes the record invalid."""
    complete = document.isNotNull() & (value > 0) & (area > 0) & state.isNotNull()
    return F.coalesce(complete, F.lit(False))


def frequency_profile(n: Column) -> Column:
    return ladder(n, operator.le, FREQUENCY_LIMITS, "MUITO_FREQUENTE")


def dispersion(sd: Column, mean: Column, flat: str, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Class of the coefficient of variation; no spread at all is ``flat``."""
    return F.when(sd.isNull() | (sd == 0), flat).otherwise(ladder(ratio(sd, mean), operator.lt, steps, otherwise))


def volatility_profile(sd: Column, mean: Column) -> Column:
    return dispersion(sd, mean, "CONSISTENTE", [(0.2, "ESTAVEL"), (0.5, "MODERADO")], "VOLATIL")


def credit_homogeneity(sd: Column, mean: Column) -> Column:
    return dispersion(sd, mean, "HOMOGENEA", [(0.3, "ESTAVEL"), (0.6, "MODERADA")], "HETEROGENEA")


def credit_volatility(sd: Column, mean: Column) -> Column:
    return dispersion(sd, mean, "HOMOGENEO", [(0.3, "ESTAVEL"), (0.6, "MODERADO")], "VOLATIL")


def diversification_profile(purposes: Column) -> Column:
    return F.when(purposes == 1, "ESPECIALIZADO").otherwise(
        ladder(purposes, operator.le, PURPOSE_COUNT_LIMITS, "DIVERSIFICADO")
    )


def crop_diversification(crops: Column) -> Column:
    return F.when(crops == 1, "MONOCULTURA").otherwise(
        ladder(crops, operator.le, CROP_COUNT_LIMITS, "ALTAMENTE_DIVERSIFICADA")
    )


def score_risk(mean_score: Column) -> Column:
    return F.when(mean_score.isNull(), 1.0).otherwise(ladder(mean_score, operator.lt, SCORE_RISK_LIMITS, 0.3))


def environmental_risk(fine_rate: Column) -> Column:
    return ladder(fine_rate, operator.gt, FINE_RISK_LIMITS, 0.3)


def density(n: Column) -> Column:
    return ladder(n, operator.lt, DENSITY_LIMITS, "MUITO_ALTA")


def region(latitude: Column) -> Column:
    return ladder(latitude, operator.gt, LATITUDE_LIMITS, "SUL")


def volume(n: Column) -> Column:
    return ladder(n, operator.lt, VOLUME_LIMITS, "MUITO_ALTO_VOLUME")


def band_weight(band: Column) -> Column:
    return ladder(band, operator.eq, BAND_WEIGHTS, 0.5)


def crop_factor(crop: Column) -> Column:
    return ladder(crop, operator.eq, CROP_FACTORS, 1.0)


def adjusted_risk(band: Column, crop: Column, fine_rate: Column) -> Column:
    return band_weight(band) * crop_factor(crop) * ladder(fine_rate, operator.gt, FINE_FACTORS, 1.0)


def person_profile(company_rate: Column) -> Column:
    return ladder(company_rate, operator.gt, COMPANY_LIMITS, "PREDOMINANTEMENTE_FISICA")


def purpose_profile(running_costs: Column, machinery: Column, expansion: Column) -> Column:
    return (
        F.when(running_costs > 0.6, "FOCO_CUSTEIO")
        .when(machinery > 0.4, "FOCO_INVESTIMENTO")
        .when(expansion > 0.3, "FOCO_EXPANSAO")
        .otherwise("DIVERSIFICADO")
    )


def risk_level(score: Column) -> Column:
    return ladder(score, operator.gt, LEVEL_LIMITS, "HIGH")


def recommendation(score: Column) -> Column:
    return ladder(score, operator.gt, DECISION_LIMITS, "DENY")


def shown_as_approved(score: Column) -> Column:
    """The front end approves at the boundary itself, unlike the recommendation."""
    return score >= 0.6
