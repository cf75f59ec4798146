"""Near-real-time silver and continuous scoring, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import scoring, serving, silver
from ..schemas import SILVER_KEY
from ..sources.changes import ChangeLog
from ..sources.events import with_dated_partitions
from ..sources.tables import merge_table
from .ingest import for_each_batch

def merge_silver_batch(table: str, changes: ChangeLog | None = None):
    """A batch function that merges bronze rows into the silver table and notes what it touches.

    A replayed batch merges the same rows again, which leaves the table as it was.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        rows = with_dated_partitions(silver.build_silver(batch, now))
        merge_table(rows, table, SILVER_KEY, ["ingestion_timestamp"], changes)

    return apply


def stream_silver(
    bronze: DataFrame, table: str, checkpoint: str, trigger: dict | None = None, changes: ChangeLog | None = None
) -> StreamingQuery:
    """Keep the silver table up to date with a stream of nested bronze rows.

    With ``changes``, gold tables learn from there what to refresh.

    Another session that has read the table before sees new files after
    ``REFRESH TABLE``, as with any files-based table.
    """
    return for_each_batch(bronze, merge_silver_batch(table, changes), checkpoint, trigger, "silver_refresh")


def stream_decisions(
    requests: DataFrame,
    served: Callable[[], Mapping[str, DataFrame]],
    path: str,
    checkpoint: str,
    predict: serving.Predict | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Decisions for a stream of flat requests, looked up in the views as each batch finds them.

    A batch is a folder of its own, so a batch that is replayed replaces its rows.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = serving.decisions(batch, served(), predict).withColumn("timestamp", F.current_timestamp())
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return for_each_batch(requests, apply, checkpoint, trigger, "decisions")


def stream_scores(bronze: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rule decisions for a stream of requests."""
    scored = scoring.decide(silver.flatten(bronze)).select(
        "proponente_id",
        "data_solicitacao",
        F.lit("success").alias("status"),
        "score",
        "credit_limit",
        "risk_level",
        "recommendation",
        F.current_timestamp().alias("timestamp"),
    )
    return (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .queryName("scores")
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
