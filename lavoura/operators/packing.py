"""Compaction in place: small files are packed into larger ones, large files stay as they are.

Files smaller than half the target are dealt, partition by partition, first fit, into bins of the
target's size; each bin with two files or more becomes one file. New files are written to a
hidden folder first. Before they are moved in, the files they replace are looked at again: a bin any
of whose files is gone or has changed is given up, and files that appeared meanwhile are left alone.

A journal in the hidden folder says which files a bin replaces. Moving in and deleting is not one
step: for that moment a reader may see a bin's rows twice, and a run that breaks off there is
finished by ``finish_packing`` or the next run.
"""

from __future__ import annotations

import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import folder_names, path_exists, remove
from ..sources.tables import table_location

BINS = "folder string, bin long, paths array<string>, bytes array<long>"
_HIDDEN = "_packing-"


def bins(files: DataFrame, target_bytes: int) -> DataFrame:
    """(folder, bin, paths, bytes) of the small files (path, bytes) to be rewritten together.

    First fit, larger files first: what is gathered are the names of one folder's small files.
    """

    def fitted(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: (-r["bytes"], r["path"]))
        room, held = [], []
        for r in rows:
            at = next((i for i, left in enumerate(room) if r["bytes"] <= left), None)
            if at is None:
                at = len(room)
                room.append(target_bytes)
                held.append([])
            room[at] -= r["bytes"]
            held[at].append(r)
        found = [(i, h) for i, h in enumerate(held) if len(h) > 1]
        return pa.table(
            {
                "folder": pa.array([key[0].as_py()] * len(found), pa.string()),
                "bin": pa.array([i for i, _ in found], pa.int64()),
                "paths": pa.array([[r["path"] for r in h] for _, h in found], pa.list_(pa.string())),
                "bytes": pa.array([[r["bytes"] for r in h] for _, h in found], pa.list_(pa.int64())),
            }
        )

    small = files.where(F.col("bytes") < target_bytes // 2).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    return small.groupBy("folder").applyInArrow(fitted, BINS)


def _fs(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def _size(spark: SparkSession, path: str) -> int | None:
    location, files = _fs(spark, path)
    return files.getFileStatus(location).getLen() if files.exists(location) else None


def _swap(spark: SparkSession, hidden: str, line: dict) -> bool:
    """Move a bin's new file in and delete those it replaces; False if it had to be given up."""
    source, files = _fs(spark, line["new"])
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{line['folder']}/part-packed-{line['id']}.parquet")
    if not files.exists(target):
        if [_size(spark, p) for p in line["paths"]] != line["bytes"] or not files.rename(source, target):
            return False
    for path in line["paths"]:
        remove(spark, path)
    return True


def finish_packing(spark: SparkSession, location: str) -> None:
    """Finish what an earlier run has begun to move in, and clear what it left."""
    for name in folder_names(spark, location):
        if not name.startswith(_HIDDEN):
            continue
        hidden = f"{location}/{name}"
        if path_exists(spark, f"{hidden}/journal"):
            for row in spark.read.text(f"{hidden}/journal").collect():
                line = json.loads(row["value"])
                # A bin whose file is not in yet is dropped: its old files are all there.
                if path_exists(spark, f"{line['folder']}/part-packed-{line['id']}.parquet"):
                    _swap(spark, hidden, line)
        remove(spark, hidden)


def pack_small_files(spark: SparkSession, table: str, files: DataFrame, target_bytes: int) -> int:
    """Pack the small ones among ``files`` (path, bytes) of a table; returns the number of new files.

    Bins come to the driver as names, those of one table's small files. Tables whose files are
    written by one job at a time may be appended to meanwhile.
    """
    location = table_location(spark, table).rstrip("/")
    finish_packing(spark, location)
    found = bins(files, target_bytes).collect()
    if not found:
        return 0
    hidden, lines = f"{location}/{_HIDDEN}{uuid.uuid4().hex}", []
    for row in found:
        made = uuid.uuid4().hex
        # The file's own columns; those of the partition are in its folder's name.
        spark.read.option("recursiveFileLookup", "true").parquet(*row["paths"]).coalesce(1).write.parquet(f"{hidden}/{made}")
        new = next(n for n in folder_names(spark, f"{hidden}/{made}") if re.match(r"part-.*\.parquet$", n))
        lines.append({"id": made, "folder": row["folder"], "new": f"{hidden}/{made}/{new}", "paths": list(row["paths"]), "bytes": list(row["bytes"])})
    journal = spark.createDataFrame([(json.dumps(x),) for x in lines], "value string")
    journal.coalesce(1).write.text(f"{hidden}/journal")
    moved = sum(_swap(spark, hidden, line) for line in lines)
    remove(spark, hidden)
    spark.catalog.refreshTable(table)
    return moved
