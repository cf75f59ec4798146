"""Event stream to bronze: source, decoding, landing and quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources import events

NESTED_TRIGGER = "60 seconds"
FLAT_TRIGGER = "30 seconds"


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Broker records of a topic; needs the spark-sql-kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_source(spark: SparkSession, path: str, topic: str = "files", max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files of one JSON event per line, in the shape of broker records."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def nested_rows(messages: DataFrame) -> DataFrame:
    """Nested bronze rows of JSON messages, stamped with their arrival at the broker."""
    decoded = events.decode_json(events.envelope(messages))
    return events.nested_bronze(decoded, F.col("kafka_timestamp"))


def flat_rows(messages: DataFrame) -> DataFrame:
    """Flat bronze rows of JSON messages, stamped with the time of processing."""
    decoded = events.decode_json(events.envelope(messages))
    return events.flat_bronze(decoded, F.current_timestamp())


def rejected_rows(messages: DataFrame) -> DataFrame:
    """Messages that decode to no applicant, with their text, for a quarantine table."""
    enveloped = events.envelope(messages).withColumn("payload", F.col("kafka_value"))
    return events.rejected(events.decode_json(enveloped)).select("kafka_key", "topic", "partition", "offset", "kafka_timestamp", "payload")


def without_repeats(rows: DataFrame, within: str = "1 day") -> DataFrame:
    """Drop re-sent applications that arrive within the given time of each other.

    Optional: the keyed merge into silver removes copies at any distance. The watermark
    follows the arrival stamp, not the request time, so a late request passes; rows whose
    arrival stamp itself runs behind the watermark do not, and ``LateRows`` counts them.
    """
    keys = ["proponente_id", "data_solicitacao", "valor_solicitado_credito"]
    return rows.withWatermark("ingestion_timestamp", within).dropDuplicatesWithinWatermark(keys)


def append_files(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    compression: str = "snappy",
) -> StreamingQuery:
    """Append a stream to Parquet files, each row exactly once across restarts.

    ``trigger`` is ``{"processingTime": "60 seconds"}`` for a running service or
    ``{"availableNow": True}`` to work off what is there and stop.
    """
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .option("compression", compression)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": NESTED_TRIGGER})).start()


class LateRows(StreamingQueryListener):
    """Keeps, per query and batch, how many rows a stream read and how many it dropped as too late.

    A batch is a folder of its own under ``path``, so one that is told again replaces itself.
    """

    SHAPE = "batch_id long, watermark string, rows_read long, rows_late long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in told.stateOperators)
        if told.numInputRows or late:
            line = (told.batchId, told.eventTime.get("watermark"), told.numInputRows, late)
            place = f"{self.path}/query={told.name or told.id}/batch={told.batchId}"
            self.spark.createDataFrame([line], self.SHAPE).coalesce(1).write.mode("overwrite").parquet(place)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def ingest_nested(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, no_repeats_within: str | None = None
) -> StreamingQuery:
    """Messages to nested bronze, by arrival month and person type.

    With ``no_repeats_within`` (such as ``1 day``) re-sent applications that arrive so close
    together are written once.
    """
    rows = nested_rows(messages)
    if no_repeats_within:
        rows = without_repeats(rows, no_repeats_within)
    return append_files(rows, path, checkpoint, events.BRONZE_PARTITIONS, trigger, "bronze_nested", "zstd")


def ingest_flat(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Messages to flat bronze, by request date."""
    return append_files(
        flat_rows(messages), path, checkpoint, events.FLAT_PARTITIONS, trigger or {"processingTime": FLAT_TRIGGER}, "bronze_flat"
    )


def quarantine(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Messages that could not be used, kept with their text."""
    return append_files(rejected_rows(messages), path, checkpoint, None, trigger, "bronze_rejected")


def for_each_batch(
    rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": NESTED_TRIGGER})).start()


def stop_gracefully(query: StreamingQuery) -> None:
    """Let the running batch finish, then stop."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
