"""Credit decisions in one go: served features, else the request's own, then a model, else rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MODEL_FEATURES, RISK_KEY
from . import features, scoring, silver

Predict = Callable[[DataFrame], DataFrame]


def model_inputs(requests: DataFrame, served: Mapping[str, DataFrame]) -> DataFrame:
    """Requests with the model inputs, and ``features_found``: whether any view knew them.

    ``served`` holds the newest row per entity of each view. Where no view knows a request, its own
    figures take their place; inputs that neither has are 0.
    """
    known = requests if set(RISK_KEY) <= set(requests.columns) else silver.classify_rows(requests)
    found = features.assemble(known, served["proponente"], served["location"], served["risk"])
    own = scoring.request_features()

    def value(name: str):
        from_views = F.col(f"f_{name}") if f"f_{name}" in found.columns else F.lit(None)
        from_request = own[name] if name in own else F.lit(None)
        chosen = F.when(F.col("features_found"), from_views.cast("double")).otherwise(from_request.cast("double"))
        return F.coalesce(chosen, F.lit(0.0)).alias(name)

    inputs = [value(n) for n in MODEL_FEATURES]
    return found.select(*[c for c in requests.columns if c not in MODEL_FEATURES], "features_found", *inputs)


def decisions(requests: DataFrame, served: Mapping[str, DataFrame], predict: Predict | None = None) -> DataFrame:
    """Requests decided: by ``predict`` where it gives a usable probability of default, else by rules.

    ``predict`` adds the column ``probability_default``. It sees the requests alone, joined with
    their features; nothing is predicted for entities nobody asked about.
    """
    inputs = model_inputs(requests, served)
    predicted = inputs.withColumn("probability_default", F.lit(None).cast("double")) if predict is None else predict(inputs)
    chance = F.col("probability_default")
    usable = F.coalesce(chance.isNotNull() & ~F.isnan(chance) & chance.between(0, 1), F.lit(False))
    decided = scoring.decide(predicted, scoring.model_or_rules(chance))
    return decided.withColumn("decided_by", F.when(usable, "model").otherwise("rules")).drop("probability_default", "prediction", *MODEL_FEATURES)
