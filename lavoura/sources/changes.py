"""Which keys a table's merges touched, for those who keep results grouped by them.

A merge writes the keys of the rows that go and of those that come before it changes the table,
and confirms them once its rows are in; readers look at confirmed keys only. So a reader that
runs between the two does not take keys as read whose rows it has not seen.

A merge that breaks off leaves keys that nobody confirmed. Its rows may be in or not, and a
repetition no longer sees the rows that went, so the next merge confirms them with its own.
Reading keys once too often is harmless. Every confirmation has an id of its own: a merge that was
confirmed early by another one's end is read again after its own.

Each write is a folder of its own, so writers do not meet. Nothing here passes the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import replaced_rows
from .staging import folder_names, path_exists, remove, staged

_BEGUN, _CONFIRMED, _READ = "load_id string", "load_id string, confirmation string", "reader string, load_id string, confirmation string"


@dataclass(frozen=True)
class ChangeLog:
    """The changes of one table: ``columns`` of the rows its merges touched, kept at ``path``."""

    spark: SparkSession
    path: str
    columns: tuple[str, ...]

    def _table(self, name: str, shape: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(f"{self.path}/{name}")

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.parquet(f"{self.path}/{name}/{uuid.uuid4().hex}")

    def prepare(self, stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> str:
        """Write down what a merge of ``incoming`` will touch, before it does; returns its load id.

        Lines may repeat: nearly every row has a line of its own, so they are not shuffled to find out.
        """
        load_id = f"merge-{uuid.uuid4().hex}"
        gone = replaced_rows(stored, incoming, keys).select(*self.columns)
        touched = gone.unionByName(incoming.select(*self.columns))
        touched.write.option("compression", "zstd").parquet(f"{self.path}/keys/load_id={load_id}")
        self._append("begun", self.spark.createDataFrame([(load_id,)], _BEGUN))
        return load_id

    def confirm(self, load_id: str) -> None:
        """The merge's rows are in: show its keys, and those of earlier merges that broke off."""
        begun = self._table("begun", _BEGUN)
        left_open = begun.join(self._table("confirmed", _CONFIRMED), "load_id", "left_anti")
        own = self.spark.createDataFrame([(load_id,)], _BEGUN)
        shown = left_open.unionByName(own).distinct()
        self._append("confirmed", shown.withColumn("confirmation", F.lit(uuid.uuid4().hex)))

    def unread(self, reader: str) -> DataFrame:
        """Confirmations (load_id, confirmation) the reader has not marked as read, as of now."""
        read = self._table("read", _READ).where(F.col("reader") == reader)
        return staged(self._table("confirmed", _CONFIRMED).join(read, ["load_id", "confirmation"], "left_anti"), "unread")

    def keys_of(self, confirmations: DataFrame) -> DataFrame:
        """``columns`` of the rows touched by the confirmed merges; some rows may repeat."""
        if not path_exists(self.spark, f"{self.path}/keys"):
            return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in self.columns))
        keys = self.spark.read.parquet(f"{self.path}/keys")
        return keys.join(confirmations.select("load_id").distinct(), "load_id", "left_semi").select(*self.columns)

    def mark_read(self, reader: str, confirmations: DataFrame) -> None:
        self._append("read", confirmations.select(F.lit(reader).alias("reader"), "load_id", "confirmation"))

    def tidy(self, readers: Sequence[str]) -> int:
        """Remove the keys of merges that all ``readers`` have read; returns how many merges.

        Of the merges only ids come to the driver: those since the last tidying.
        """
        shown = self._table("confirmed", _CONFIRMED)
        read = self._table("read", _READ).where(F.col("reader").isin(list(readers)))
        seen = read.groupBy("load_id", "confirmation").agg(F.countDistinct("reader").alias("n")).where(F.col("n") == len(readers))
        unseen = shown.join(seen, ["load_id", "confirmation"], "left_anti").select("load_id")
        ids = [(f.removeprefix("load_id="),) for f in folder_names(self.spark, f"{self.path}/keys") if f.startswith("load_id=")]
        present = self.spark.createDataFrame(ids, _BEGUN)
        done = present.join(shown.select("load_id").distinct(), "load_id", "left_semi").join(unseen, "load_id", "left_anti").collect()
        for row in done:
            remove(self.spark, f"{self.path}/keys/load_id={row['load_id']}")
        return len(done)
