"""Default-risk model: features, target, training, evaluation and the deployment gate."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clamp, hash_uniform, instant
from ..schemas import MODEL_FEATURES
from .quantiles import exact_medians, exact_percentiles

# medians' defaults when a column has no value at all, and plain fills.
MEDIAN_DEFAULTS = {
    "valor_total_solicitado": 50000.0,
    "anos_experiencia_medio": 10.0,
    "serasa_score_medio": 600.0,
    "area_media_hectares": 100.0,
}
PLAIN_FILLS = {"taxa_autuacoes_ibama": 0.0, "diversidade_culturas": 1}
BASE_PROBABILITY = 0.3
SEED = 42
MAX_LOSS = 0.05


def model_features(gold_proponente: DataFrame) -> DataFrame:
    return gold_proponente.select("proponente_id", *MODEL_FEATURES)


def impute(features: DataFrame) -> DataFrame:
    """Fill gaps: medians for four columns, fixed values for two."""
    medians = exact_medians(features, list(MEDIAN_DEFAULTS))
    # One row by construction, so it can be read as a scalar.
    found = medians.select(F.struct(*[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in MEDIAN_DEFAULTS.items()])).scalar()
    return features.withColumns({c: F.coalesce(F.col(c), found[c]) for c in MEDIAN_DEFAULTS}).fillna(PLAIN_FILLS)


def default_probability() -> Column:
    """Chance of default of an imputed feature row, within 0.1..0.9."""
    value = clamp(F.col("valor_total_solicitado") / 200000, 0.0, 2.0)
    experience = clamp(F.col("anos_experiencia_medio") / 30, 0.0, 2.0)
    bureau = clamp(F.col("serasa_score_medio") / 900, 0.0, 1.0)
    area = clamp(F.col("area_media_hectares") / 1000, 0.0, 2.0)
    shift = (value - 1) * 0.05 + (1 - experience) * 0.1 + (bureau - 0.5) * 0.2 + (area - 1) * 0.03
    chance = clamp(BASE_PROBABILITY + shift, 0.1, 0.9)
    usable = chance.isNotNull() & ~F.isnan(chance)
    return F.when(usable, chance).otherwise(BASE_PROBABILITY)


def with_target(imputed: DataFrame) -> DataFrame:
    """Append the default probability and a repeatable draw from it."""
    drawn = hash_uniform(f"target-{SEED}", F.col("proponente_id")) < F.col("default_probability")
    return imputed.withColumn("default_probability", default_probability()).withColumn("target_default", drawn.cast("int"))


def split(labelled: DataFrame, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Stratified split: in each class the exact share with the smallest hash is for training."""
    drawn = labelled.withColumn("_u", hash_uniform(f"split-{SEED}", F.col("proponente_id")))
    limits = exact_percentiles(drawn, ["target_default"], "_u", {"_limit": train_share})
    # One row per class of a binary target.
    marked = drawn.join(F.broadcast(limits), "target_default")
    train = marked.where(F.col("_u") <= F.col("_limit")).drop("_u", "_limit")
    test = marked.where(F.col("_u") > F.col("_limit")).drop("_u", "_limit")
    return train, test


def model_pipeline(trees: int = 100) -> Pipeline:
    """Vector, standardisation and forest as one saved unit."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=MODEL_FEATURES, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            RandomForestClassifier(
                labelCol="target_default",
                featuresCol="features",
                numTrees=trees,
                maxDepth=10,
                minInstancesPerNode=2,
                seed=SEED,
            ),
        ]
    )


def fitted_scaler(rows: DataFrame) -> StandardScalerModel:
    """The standardisation alone, as the pipeline fits it on training rows."""
    assembler, scaler, _ = model_pipeline().getStages()
    return scaler.fit(assembler.transform(_zero_filled(rows)))


def _zero_filled(rows: DataFrame) -> DataFrame:
    return rows.fillna(0, subset=MODEL_FEATURES)


def train(rows: DataFrame, trees: int = 100) -> PipelineModel:
    return model_pipeline(trees).fit(_zero_filled(rows))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the predicted class and the probability of default."""
    scored = model.transform(_zero_filled(rows))
    return scored.withColumn("probability_default", vector_to_array("probability")[1]).drop(
        "raw_features", "features", "rawPrediction", "probability"
    )


def classification_metrics(predictions: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 as one row.

    Only the table of (actual, predicted) counts leaves the first grouping.
    """
    cells = predictions.groupBy(F.col(label).alias("a"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # Each cell adds its rows to its actual class and to its predicted class.
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("cls"), F.col("n").alias("support"), F.lit(0).alias("named"), F.lit(0).alias("hits")),
                F.struct(
                    F.col("p").alias("cls"),
                    F.lit(0).alias("support"),
                    F.col("n").alias("named"),
                    F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hits"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    classes = sides.groupBy("cls").agg(
        F.sum("support").cast("double").alias("support"),
        F.sum("named").cast("double").alias("named"),
        F.sum("hits").cast("double").alias("hits"),
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("named")), zero)
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), zero)
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero)
    total = F.sum("support")
    return classes.agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(precision * F.col("support")) / total).alias("precision"),
        (F.sum(recall * F.col("support")) / total).alias("recall"),
        (F.sum(f1 * F.col("support")) / total).alias("f1"),
        total.cast("long").alias("n"),
    )


def gate(current: DataFrame, previous: DataFrame, drift: DataFrame) -> DataFrame:
    """Degradation against the previous run and the deployment decision.

    All three inputs are one-row results. Without previous metrics nothing counts as
    degraded.
    """
    new = current.select("accuracy", "f1")
    old = previous.select(F.col("accuracy").alias("previous_accuracy"), F.col("f1").alias("previous_f1"))
    lines = new.unionByName(old, allowMissingColumns=True).unionByName(drift.select("drift_detected"), allowMissingColumns=True)
    side_by_side = lines.agg(*[F.max(c).alias(c) for c in lines.columns])
    worse = (F.col("accuracy") < F.col("previous_accuracy") - MAX_LOSS) | (F.col("f1") < F.col("previous_f1") - MAX_LOSS)
    return side_by_side.withColumn("performance_degraded", F.coalesce(worse, F.lit(False))).withColumn(
        "deploy", F.col("drift_detected") | F.col("performance_degraded")
    )


def stamped_metrics(metrics: DataFrame, trained_at: datetime | str | Column) -> DataFrame:
    """Metrics as a line of the append-only metrics table."""
    return metrics.withColumn("training_date", instant(trained_at))


def newest_metrics(history: DataFrame) -> DataFrame:
    """The metrics of the latest recorded run (no row when there is none)."""
    newest = history.agg(F.max(F.struct("training_date", *[c for c in history.columns if c != "training_date"])).alias("m"))
    return newest.where(F.col("m").isNotNull()).select("m.*")


def require_rows(df: DataFrame, name: str) -> None:
    """Stop a run whose input table is empty."""
    if df.isEmpty():
        raise ValueError(f"no rows in {name}")
