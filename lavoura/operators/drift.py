"""Two-sample Kolmogorov-Smirnov drift test, computed without ordering a feature in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import DRIFT_FEATURES
from ..sources.staging import path_exists, staged

# Distinct values in a slice, about.
SLICE_VALUES = 50_000
SERIES_TERMS = 100
MIN_ROWS = 30
SIGNIFICANCE = 0.05


def _survival(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic p-value of a KS distance, limited to 0..1."""
    lam2 = distance * distance * (n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam2),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    # The alternating series does not settle for a distance near zero, where p is 1.
    return F.when(lam2 < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def ks_drift(
    current: DataFrame, baseline: DataFrame, features: Sequence[str] = DRIFT_FEATURES, slice_values: int = SLICE_VALUES
) -> DataFrame:
    """One row per feature: sample sizes, KS distance, critical value, p-value and drift flag.

    Values are first counted per distinct value, and these dealt out by ranges of feature and
    value, as many as their number asks for. Running counts are formed inside a range, and a range
    passes on only its totals and its greatest and smallest local difference.
    """
    both = current.select(F.lit(1).alias("is_current"), *features).unionByName(
        baseline.select(F.lit(0).alias("is_current"), *features)
    )
    doubles = both.select("is_current", *[F.col(f).cast("double").alias(f) for f in features])
    long = doubles.unpivot(["is_current"], list(features), "feature", "value")
    counts = staged(
        long.where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.sum("is_current").alias("c"), F.sum(1 - F.col("is_current")).alias("b")),
        "ks-counts",
    )
    sizes = counts.groupBy("feature").agg(F.sum("c").alias("n_current"), F.sum("b").alias("n_baseline"))
    ranges = max(1, math.ceil(counts.count() / slice_values))
    # Written at once, so that a range keeps its number.
    ranged = staged(counts.repartitionByRange(ranges, "feature", "value").withColumn("slice", F.spark_partition_id()), "ks-ranges")
    # One line per feature of the list above, whatever the data.
    sliced = ranged.join(F.broadcast(sizes), "feature")
    upward = Window.partitionBy("feature", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    # c*m - b*n compares the two running shares without rounding.
    step = (F.col("c").cast("decimal(38,0)") * F.col("n_baseline") - F.col("b").cast("decimal(38,0)") * F.col("n_current")).cast(
        "decimal(38,0)"
    )
    local = sliced.withColumn("gap", F.sum(step).over(upward).cast("decimal(38,0)")).withColumn("step", step)
    per_slice = local.groupBy("feature", "n_current", "n_baseline", "slice").agg(
        F.max("gap").alias("high"), F.min("gap").alias("low"), F.sum("step").cast("decimal(38,0)").alias("total")
    )
    # One line per range and feature from here on.
    before = Window.partitionBy("feature").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("total").over(before), F.lit(0).cast("decimal(38,0)"))
    reach = per_slice.withColumn("carried", carried).withColumn(
        "reach", F.greatest(F.abs(F.col("carried") + F.col("high")), F.abs(F.col("carried") + F.col("low")))
    )
    n, m = F.col("n_current").cast("double"), F.col("n_baseline").cast("double")
    measured = (
        reach.groupBy("feature", "n_current", "n_baseline")
        .agg(F.max("reach").cast("double").alias("reach"))
        .withColumn("ks_statistic", F.try_divide(F.col("reach"), n * m))
        .withColumn("critical_value", 1.358 * F.sqrt(F.try_divide(n + m, n * m)))
        .withColumn("p_value", _survival(F.col("ks_statistic"), n, m))
    )
    enough = (F.col("n_current") > MIN_ROWS) & (F.col("n_baseline") > MIN_ROWS)
    drifted = enough & F.coalesce(F.col("p_value") < SIGNIFICANCE, F.lit(False))
    return measured.select(
        "feature", "n_current", "n_baseline", "ks_statistic", "critical_value", "p_value", drifted.alias("drift_detected")
    )


def drift_summary(tested: DataFrame) -> DataFrame:
    """One row: was any feature found to drift, and which."""
    names = F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature"))))
    return tested.agg(
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("drift_detected"),
        F.array_join(names, ",").alias("drift_features"),
    )


def baseline_or_first(spark: SparkSession, path: str, current: DataFrame) -> tuple[DataFrame, bool]:
    """The stored baseline, or the current rows stored as one when there is none yet.

    The flag tells whether the baseline was there before (only then can drift be tested).
    """
    existed = path_exists(spark, f"{path}/_SUCCESS")
    if not existed:
        current.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), existed
