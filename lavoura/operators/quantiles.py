"""Exact order statistics of very large groups, without gathering a group anywhere.

The value at a rank is found by narrowing: the range of a group's values is cut into STEPS equal
slices, the slice in which the rank falls becomes the new range, and so on until a range holds at
most ORDERED distinct values, which are then put in order. Every round divides the width by STEPS, so
their number has a bound whatever the values are: doubles have 64 bits. What is grouped are slice
numbers, with map-side partial results, and from the second round on only rows of the ranges are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged

STEPS = 1024
ORDERED = 4096


def _slice(value: Column, low: Column, high: Column) -> Column:
    """Which of STEPS equal slices of [low, high] holds the value; never falls as the value grows."""
    place = F.floor((value - low) / (high - low) * F.lit(STEPS))
    return F.when(high > low, F.least(place, F.lit(STEPS - 1).cast("long"))).otherwise(F.lit(0).cast("long"))


def _narrowed(ranges: DataFrame, rows: DataFrame, keys: Sequence[str], per_target: bool) -> DataFrame:
    """``ranges`` with the slice in which each rank falls for range; ``rows`` are those inside it."""
    on = [*keys, "target"] if per_target else list(keys)
    bounds = ranges.select(*on, "low", "high").distinct()
    number = F.col("_v").cast("double")
    slices = (
        rows.join(bounds, on)
        .groupBy(*on, _slice(number, F.col("low"), F.col("high")).alias("slice"))
        .agg(F.sum("_w").alias("w"), F.count(F.lit(1)).alias("size"), F.min(number).alias("low"), F.max(number).alias("high"))
    )
    # At most STEPS lines for each range.
    slices = staged(slices, "slices")
    upward = Window.partitionBy(*on).orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = slices.withColumn("upto", F.sum("w").over(upward))
    placed = ranges.drop("low", "high", "size").join(running, on)
    rank = F.col("rank") - F.col("below")
    chosen = placed.where((F.col("upto") >= rank) & (F.col("upto") - F.col("w") < rank))
    return chosen.withColumn("below", F.col("below") + F.col("upto") - F.col("w")).select(*keys, "target", "n", "rank", "below", "low", "high", "size")


def _inside(rows: DataFrame, ranges: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct values of ``rows`` inside each range and how many rows have them."""
    number = F.col("_v").cast("double")
    held = rows.join(ranges.select(*{*on, "target"}, "low", "high"), list(on)).where(number.between(F.col("low"), F.col("high")))
    keys = [c for c in on if c != "target"]
    return held.groupBy(*keys, "target", "_v").agg(F.sum("_w").alias("_w"))


def _distinct_inside(rows: DataFrame, ranges: DataFrame, by: Sequence[str], on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The values inside the ranges, and the ranges with the number of these."""
    inside = staged(_inside(rows, ranges, by), "inside")
    sizes = inside.groupBy(*on).agg(F.count(F.lit(1)).alias("size"))
    return inside, staged(ranges.drop("size").join(sizes, list(on)).select(*ranges.columns), "ranges")


def _order_statistics(df: DataFrame, keys: Sequence[str], value: str, targets: Sequence[Column], copies: str | None = None) -> DataFrame:
    """Rows (keys, target index, n, exact value at the target's rank).

    ``targets`` are 1-based ranks as expressions of ``n``, the number of the group's values. With
    ``copies`` a row stands for that many of its value.
    """
    weight = F.lit(1).cast("long") if copies is None else F.col(copies).cast("long")
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), weight.alias("_w"))
    rows = staged(rows, "ranked")
    number = F.col("_v").cast("double")
    groups = rows.groupBy(*keys).agg(F.sum("_w").alias("n"), F.count(F.lit(1)).alias("size"), F.min(number).alias("low"), F.max(number).alias("high"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("target"), r.cast("long").alias("rank")) for i, r in enumerate(targets)]))
    ranges = groups.withColumn("t", each).select(
        *keys, "t.target", "n", "t.rank", F.lit(0).cast("long").alias("below"), "low", "high", "size"
    )
    ranges = staged(ranges, "ranges")
    wide = (F.col("size") > ORDERED) & (F.col("high") > F.col("low"))
    on = [*keys, "target"]
    if ranges.where(wide).isEmpty():
        inside = _inside(rows, ranges, list(keys))
    else:
        # The first cut is the same for all targets of a group; after it a row is a distinct value.
        first = _narrowed(ranges.where(wide), rows, keys, per_target=False)
        ranges = staged(ranges.where(~wide).unionByName(first), "ranges")
        inside, ranges = _distinct_inside(rows, ranges, list(keys), on)
        while not ranges.where(wide).isEmpty():
            narrower = _narrowed(ranges.where(wide), inside, keys, per_target=True)
            inside, ranges = _distinct_inside(inside, staged(ranges.where(~wide).unionByName(narrower), "ranges"), on, on)
    # At most ORDERED values for each target, or decimals that are one and the same double.
    upward = Window.partitionBy(*on).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = inside.withColumn("_upto", F.sum("_w").over(upward))
    reached = running.join(ranges, on).where(F.col("below") + F.col("_upto") >= F.col("rank"))
    return reached.groupBy(*on, "n").agg(F.min("_v").alias("value"))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], copies: str | None = None) -> DataFrame:
    """Discrete percentiles: the smallest value that at least that part of the rows reach.

    With ``copies`` a row stands for that many of its value.
    """
    targets = [F.greatest(F.ceil(F.lit(p) * F.col("n")), F.lit(1)) for p in probabilities.values()]
    found = _order_statistics(df, keys, value, targets, copies)
    return found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("target") == i, F.col("value"))).alias(name) for i, name in enumerate(probabilities)]
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the interpolated median of each column, NULL for a column without values."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    lower = F.floor((F.col("n") + 1) / 2)
    upper = F.floor((F.col("n") + 2) / 2)
    found = _order_statistics(long, ["feature"], "value", [lower, upper])
    halves = {
        c: [F.max(F.when((F.col("feature") == c) & (F.col("target") == t), F.col("value"))) for t in (0, 1)] for c in columns
    }
    return found.agg(*[((low + high) / 2).alias(c) for c, (low, high) in halves.items()])
