"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key whose rate is its quality weight (Efraimidis and
Spirakis); in ascending order of keys, heavier documents tend to come first. A source that is
to give more than its size first gives complete epochs; the rest is the head of that order, up to
the budget; one more document closes the gap.

The order is a global range sort on (source, key), so a source with most of the rows is spread
over as many tasks as its share. Each task sums up its own slice, and the slices' totals are
summed up in a second step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavoura.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a slice, on average, without and with whole documents in them.
SLICE, SLICE_OF_TEXTS = 50_000, 3_000


def words(column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn and divide ``share`` times
    all sizes by weight. None gets more than ``most`` times its size; the excess is divided
    among the others. With limits per weight in ascending order, a source is at its limit if
    what is left after all lower limits would give it that much.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    of_turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = sizes.withColumn("weight", of_turn).withColumn("limit", F.col("source_size") * float(most))
    rows = rows.withColumn("ratio", F.col("limit") / F.col("weight"))
    rows = rows.withColumn("wanted", F.sum("source_size").over(everything) * float(share))
    upto = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = Window.orderBy("ratio").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("wanted") - F.sum("limit").over(upto) + F.sum("limit").over(Window.partitionBy("ratio"))
    rows = rows.withColumn("full", left >= F.col("ratio") * F.sum("weight").over(from_here))
    free = F.col("wanted") - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(everything), F.lit(0.0))
    rate = free / F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.least(F.col("limit"), rate * F.col("weight")))
    return rows.select("source", "source_size", target.alias("target"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of the slice, and the sizes that come before each row in its source and slice."""
    number, running = TaskContext.get().partitionId(), {}
    for batch in batches:
        size = batch.column("size").to_numpy()
        source = batch.column("source").to_pylist()
        before = np.cumsum(size) - size
        # Rows of a source stand together.
        starts = [i for i in range(len(source)) if i == 0 or source[i] != source[i - 1]]
        for a, b in zip(starts, [*starts[1:], len(source)], strict=True):
            before[a:b] += running.get(source[a], 0) - before[a]
            running[source[a]] = int(before[b - 1] + size[b - 1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(size), number), pa.int64()), pa.array(before, pa.int64())],
            [*batch.schema.names, "slice", "before"],
        )


def mixed(
    docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    seed: int = 0, with_row: bool = False,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, times[, row]) for every row of ``docs``.

    ``docs`` has doc_id, text and source, and maybe others; ``row`` is a struct of all of them. ``quality``, if given, has (doc_id, weight): a document
    of weight w comes early with w times the rate; documents without one weigh 1, weights that
    are not positive count as 1. size is the number of words of the text (none if null), taken
    is ``times`` that: whole documents only. A source's complete epochs are the whole part of
    target over size. Of the rest it gives the head of its order that fits, and then the one
    other document whose size is nearest to what is left, if that comes nearer to the target.

    Null sources are one source, last in order. Null ids are documents like others. Repeated
    rows are sampled one by one; which of several equal rows is taken is not told apart. Keys
    are hashes of id, source and size, so reruns agree.
    """
    keep = ["row"] if with_row else []
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_row else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words("text").alias("size"), *whole)
    if quality is not None:
        own = quality.groupBy(F.col("doc_id").cast("long").alias("quality_id")).agg(F.max("weight").cast("double").alias("weight"))
        rows = rows.join(own, rows.doc_id == own.quality_id, "left").drop("quality_id")
        rows = rows.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0))
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    uniform = (F.xxhash64("doc_id", "source", "size", F.lit(seed)).cast("double") + 2.0**63) / 2.0**64
    rows = rows.withColumn("key", -F.log(F.greatest(uniform, F.lit(1e-18))) / F.col("weight")).drop("weight")
    slices = max(1, math.ceil(docs.count() / (SLICE_OF_TEXTS if with_row else SLICE)))
    order = ["source", "key", "doc_id"]
    ranged = rows.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", slice long, before long"
    ranged = staged(ranged.mapInArrow(_slices, schema), "mix-ranged")

    totals = staged(ranged.groupBy("source", "slice").agg(F.sum("size").alias("total")), "mix-totals")
    goal = targets(totals.groupBy("source").agg(F.sum("total").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("total").over(earlier), F.lit(0))).drop("total")
    plan = offsets.join(goal, offsets.source.eqNullSafe(goal.source)).drop(goal.source)
    plan = staged(plan.withColumnRenamed("source", "plan_source").withColumnRenamed("slice", "plan_slice"), "mix-plan")

    size = F.col("size")
    epochs = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    rows = ranged.join(plan, (ranged.slice == plan.plan_slice) & ranged.source.eqNullSafe(plan.plan_source))
    rows = rows.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    upto = F.col("offset") + F.col("before") + size
    fits = upto <= F.col("rest")

    # The head of the order that fits, and the document that fills what is left best.
    heads = rows.groupBy("source").agg(F.coalesce(F.max(F.when(fits, upto)), F.lit(0)).alias("used"))
    heads = staged(heads.withColumnRenamed("source", "head_source"), "mix-heads")
    gap = F.col("rest") - F.col("used")
    others = rows.where(~fits & (size > 0)).join(heads, rows.source.eqNullSafe(heads.head_source))
    others = others.withColumn("off", F.abs(gap - size)).where(F.col("off") < gap)
    last = others.groupBy("source").agg(F.min(F.struct("off", "slice", "before")).alias("last"))
    last = staged(last.select(F.col("source").alias("last_source"), "last.slice", "last.before").toDF("last_source", "last_slice", "last_before"), "mix-last")

    is_last = (F.col("slice") == F.col("last_slice")) & (F.col("before") == F.col("last_before")) & ~fits
    rows = rows.join(last, rows.source.eqNullSafe(last.last_source), "left")
    more = (size > 0) & (fits | F.coalesce(is_last, F.lit(False)))
    times = (F.col("epochs") + more.cast("long")).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", (times * size).alias("taken"), times.alias("times"), *keep)
