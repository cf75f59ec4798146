"""Table-level statistics and partition counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import instant


def table_stats(silver: DataFrame, exact: bool = False) -> DataFrame:
    """Rows, applicants, request span and number of states (sketched unless ``exact``)."""
    states = F.count_distinct("localizacao_uf") if exact else F.approx_count_distinct("localizacao_uf")
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("proponente_id").alias("unique_proponentes"),
        F.min("data_solicitacao").alias("min_date"),
        F.max("data_solicitacao").alias("max_date"),
        states.alias("unique_states"),
    )


#: Registers of a distinct sketch as a power of two; the relative standard error is 1.04 / 2 ** (LOG_REGISTERS / 2).
LOG_REGISTERS = 12
SKETCH_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def daily_sketches(silver: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(ano, mes, dia, localizacao_uf, n, and a sketch of each column's distinct values) per day and state.

    Stored by ``ano`` and ``mes``, the sketches of a month are computed anew when a merge touches it.
    """
    day = F.to_date("data_solicitacao")
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_REGISTERS)).alias(f"{c}__sketch") for c in columns]
    return (
        silver.groupBy(F.year(day).alias("ano"), F.month(day).alias("mes"), day.alias("dia"), "localizacao_uf")
        .agg(F.count(F.lit(1)).alias("n"), *sketches)
    )


def distinct_between(sketches: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows and estimated distinct values per group over the days from ``start`` to before ``end``.

    Only sketches are read: as many lines as the period has days and states.
    """
    found = sketches.where((F.col("dia") >= F.lit(start).cast("date")) & (F.col("dia") < F.lit(end).cast("date")))
    columns = [c.removesuffix("__sketch") for c in sketches.columns if c.endswith("__sketch")]
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}__sketch")).alias(f"{c}__distinct") for c in columns]
    return found.groupBy(*by).agg(F.sum("n").alias("n"), *estimates)


def load_metrics(silver: DataFrame, table_name: str, as_of: datetime | str | Column) -> DataFrame:
    """The figures recorded after each silver load."""
    return silver.agg(
        F.lit(table_name).alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("proponente_id").alias("unique_proponentes"),
        F.max("ingestion_timestamp").alias("last_ingestion"),
        F.first(instant(as_of)).alias("metric_timestamp"),
    )


def small_partitions(df: DataFrame, partition_columns: list[str], below: int = 1000) -> DataFrame:
    """Partitions with fewer rows than ``below``, smallest first."""
    return (
        df.groupBy(*partition_columns)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .where(F.col("record_count") < below)
        .orderBy("record_count", *partition_columns)
    )
