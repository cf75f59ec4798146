"""Batch feature job over raw events: stand-in crop, distance and debt figures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_parts, hash_uniform, instant

# The reference port and the defaults without a position.
PORT_LATITUDE = -23.9875
PORT_LONGITUDE = -46.3039
DEFAULT_DISTANCE = 500.0
DEFAULT_NDVI = 0.5

PARTITIONS = ["year", "month", "day"]


def _has_position(latitude: Column, longitude: Column) -> Column:
    """A coordinate of exactly zero counts as missing."""
    return F.coalesce((latitude != 0) & (longitude != 0), F.lit(False))


def ndvi(latitude: Column, longitude: Column, *identity: Column) -> Column:
    """Vegetation index stand-in: 0.1 to 0.9, fixed by the identity of the event."""
    drawn = F.round(F.lit(0.1) + hash_uniform("ndvi", *identity) * F.lit(0.8), 4)
    return F.when(_has_position(latitude, longitude), drawn).otherwise(DEFAULT_NDVI)


def port_distance(latitude: Column, longitude: Column) -> Column:
    """Grid distance to the port, in hundredths of a degree."""
    grid = F.abs(latitude - PORT_LATITUDE) * 100 + F.abs(longitude - PORT_LONGITUDE) * 100
    return F.when(_has_position(latitude, longitude), F.round(grid, 2)).otherwise(DEFAULT_DISTANCE)


def simple_credit_score(income: Column, payments: Column, queries: Column) -> Column:
    """600 plus income points minus penalties, cut to whole points within 300..850."""

    def part(value: Column, points: Column) -> Column:
        return F.when(value.isNotNull(), points).otherwise(F.lit(0.0))

    raw = (
        F.lit(600.0)
        + part(income, income.cast("double") / 10000)
        - part(payments, payments.cast("double") * 20)
        - part(queries, queries.cast("double") * 10)
    )
    # Limited before the cast: an extreme income must not overflow the integer.
    return F.greatest(F.lit(300.0), F.least(F.lit(850.0), raw)).cast("int")


def event_features(bronze: DataFrame, loaded_at: datetime | str | Column) -> DataFrame:
    """The twelve-column feature row of every raw event."""
    latitude, longitude = F.col("localizacao_propriedade.latitude"), F.col("localizacao_propriedade.longitude")
    identity = [F.col("proponente_id"), F.col("data_solicitacao")]
    snapshot = F.timestamp_millis("data_solicitacao")
    return bronze.select(
        "proponente_id",
        ndvi(latitude, longitude, *identity).cast("float").alias("avg_ndvi_90d"),
        port_distance(latitude, longitude).cast("float").alias("distancia_porto_km"),
        F.col("fontes_dados_adicionais.serasa_score").cast("int").alias("score_credito_externo"),
        F.floor(hash_uniform("idade", *identity) * 180 + 30).cast("int").alias("idade_cultura_predominante_dias"),
        F.col("area_total_hectares").cast("float").alias("area_total_propriedade_ha"),
        (hash_uniform("divida", *identity) * F.lit(0.8) + F.lit(0.1)).cast("float").alias("percentual_endividamento_total"),
        snapshot.alias("data_snapshot"),
        instant(loaded_at).alias("data_carga_gold"),
        *date_parts(snapshot, PARTITIONS),
    )


def write_features(features: DataFrame, path: str) -> None:
    """Feature rows without the date columns, replacing what is there."""
    features.drop(*PARTITIONS).write.mode("overwrite").parquet(path)


def write_features_by_day(features: DataFrame, path: str) -> None:
    """Feature rows per day; only the days present are replaced."""
    (
        features.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
