"""Most frequent and distinct values per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def most_common(column: str) -> Column:
    """The most frequent value, the smallest at a tie; NULL never counts.

    Meant for category columns: the state per group is one counter per distinct value,
    and map tasks merge theirs before rows are shuffled.
    """
    return F.mode(column, deterministic=True)


def kinds(column: str) -> Column:
    """Number of distinct values of a category column.

    A set of the few values costs less than ``count(distinct)``, which repeats every
    row once per counted column. Identifiers belong to ``count_identifiers``.
    """
    return F.size(F.collect_set(column)).cast("long")


def count_identifiers(df: DataFrame, keys: Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """One row per key with the number of distinct values of many-valued columns.

    ``counts`` maps output names to source columns. Values are made distinct per (key,
    column, value), which spreads a hot key over its values; no task ever holds the
    values of a group.
    """
    columns = list(dict.fromkeys(counts.values()))
    long = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(list(keys), columns, "_column", "_value")
    per_column = (
        long.where(F.col("_value").isNotNull()).distinct().groupBy(*keys, "_column").agg(F.count(F.lit(1)).alias("_n"))
    )
    return per_column.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("_column") == c, F.col("_n"))), F.lit(0)).alias(name) for name, c in counts.items()]
    )


def mode_by_key(df: DataFrame, keys: Sequence[str], column: str, name: str = "most_common") -> DataFrame:
    return df.groupBy(*keys).agg(most_common(column).alias(name))
