"""Event payloads: envelope, decoding and the nested and flat bronze shapes.

Each function maps DataFrame to DataFrame and works alike on a batch and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import date_parts, instant, path_safe
from ..schemas import APPLICATION

BRONZE_PARTITIONS = ["mes_ingestao", "tipo_pessoa"]
DATED_PARTITIONS = ["ano", "mes", "tipo_pessoa"]
FLAT_PARTITIONS = ["ano_particao", "mes_particao", "dia_particao"]
LANDING_PARTITIONS = ["year", "month", "day", "hour"]


def envelope(messages: DataFrame) -> DataFrame:
    """Broker records with key and value read as text."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def decode_json(enveloped: DataFrame, schema: T.StructType | str = APPLICATION, payload: str = "kafka_value") -> DataFrame:
    """Replace the JSON payload by the record's fields; a malformed payload gives NULL fields."""
    rest = [c for c in enveloped.columns if c != payload]
    decoded = enveloped.select(*rest, F.from_json(F.col(payload), schema).alias("data"))
    return decoded.select(*rest, "data.*")


def decode_avro(messages: DataFrame, avro_schema: str) -> DataFrame:
    """Decode headerless Avro values; needs the spark-avro package on the class path."""
    from pyspark.sql.avro.functions import from_avro

    decoded = messages.select(from_avro(F.col("value"), avro_schema).alias("data")).select("data.*")
    return instants_to_millis(decoded)


def instants_to_millis(decoded: DataFrame) -> DataFrame:
    """Avro's timestamp-millis arrive as instants; bronze keeps epoch milliseconds.

    Columns that are numbers already are left alone, so each time is converted once.
    """
    out = decoded
    if isinstance(out.schema["data_solicitacao"].dataType, T.TimestampType):
        out = out.withColumn("data_solicitacao", F.unix_millis("data_solicitacao"))
    generated = out.schema["metadata_evento"].dataType["timestamp_geracao_evento"].dataType
    if isinstance(generated, T.TimestampType):
        out = out.withColumn(
            "metadata_evento",
            F.col("metadata_evento").withField(
                "timestamp_geracao_evento", F.unix_millis("metadata_evento.timestamp_geracao_evento")
            ),
        )
    return out


def nested_bronze(decoded: DataFrame, ingested_at: Column | str) -> DataFrame:
    """Nested bronze rows: identified records, stamped with their arrival time."""
    fields = [f.name for f in APPLICATION.fields]
    return (
        decoded.where(F.col("proponente_id").isNotNull())
        .select(*fields, instant(ingested_at).alias("ingestion_timestamp"))
        .withColumn("mes_ingestao", F.date_format("ingestion_timestamp", "yyyy-MM"))
    )


def rejected(decoded: DataFrame) -> DataFrame:
    """Records nested bronze leaves out: malformed payload or no applicant."""
    return decoded.where(F.col("proponente_id").isNull())


def flat_bronze(decoded: DataFrame, ingested_at: Column | str) -> DataFrame:
    """Flat bronze rows with request-date partition columns."""
    requested = F.timestamp_millis("data_solicitacao")
    return decoded.select(
        "proponente_id",
        requested.alias("data_solicitacao"),
        "cpf_cnpj",
        "nome_razao_social",
        "tipo_pessoa",
        "renda_bruta_anual_declarada",
        "valor_solicitado_credito",
        "finalidade_credito",
        *[
            F.col(f"localizacao_propriedade.{name}").alias(f"localizacao_{name}")
            for name in ("latitude", "longitude", "municipio", "uf")
        ],
        "area_total_hectares",
        "cultura_principal",
        "possui_experiencia_atividade",
        "anos_experiencia",
        "fontes_dados_adicionais.*",
        "metadata_evento.versao_schema",
        "metadata_evento.origem_dados",
        F.timestamp_millis("metadata_evento.timestamp_geracao_evento").alias("timestamp_geracao_evento"),
        instant(ingested_at).alias("data_ingestao"),
        *date_parts(requested, FLAT_PARTITIONS),
    )


def with_dated_partitions(rows: DataFrame) -> DataFrame:
    """Append request year and month, which with the person type make up ``DATED_PARTITIONS``."""
    at = F.col("data_solicitacao")
    return rows.withColumns({"ano": F.year(at), "mes": F.month(at)})


def to_messages(bronze: DataFrame, topic: str, partitions: int = 3) -> DataFrame:
    """Broker-shaped records holding each application as JSON."""
    fields = [f.name for f in APPLICATION.fields]
    return bronze.select(
        F.col("proponente_id").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("proponente_id"), F.lit(partitions)).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        F.col("ingestion_timestamp").alias("timestamp"),
    )


def landing_path(identifier: Column, at: Column) -> Column:
    """Object name of one raw event: hour folder, safe identifier, arrival time."""
    safe = path_safe(F.coalesce(identifier, F.lit("unknown_proponente")))
    return F.concat(
        F.date_format(at, "yyyy/MM/dd/HH"), F.lit("/"), safe, F.lit("_"), F.date_format(at, "yyyyMMddHHmmssSSSSSS"), F.lit(".json")
    )


def land_json(bronze: DataFrame, path: str) -> None:
    """Append raw events as JSON under one folder per arrival hour."""
    at = F.col("ingestion_timestamp")
    parts = dict(zip(LANDING_PARTITIONS, ("yyyy", "MM", "dd", "HH")))
    rows = bronze.select("*", *[F.date_format(at, fmt).alias(name) for name, fmt in parts.items()])
    # Rebalancing gathers each hour into few files and splits an hour that is too big for one.
    rows.hint("rebalance", *LANDING_PARTITIONS).write.mode("append").partitionBy(*LANDING_PARTITIONS).json(path)


def read_landing(spark, path: str, schema: T.StructType = APPLICATION) -> DataFrame:
    """Every raw JSON event below ``path``, however deep the date folders are."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
