"""Catalog tables over Parquet files: creation, version swaps and partition-wise merges."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import merged_rows, surviving, unique_rows
from .changes import ChangeLog
from .staging import path_exists, scratch


#: Rows of one partition that a task of a merge takes.
TASK_ROWS = 500_000
#: Files per partition that a write may leave rather than shuffle its rows.
FILES = 6


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, path: str, partition_by: Sequence[str] = ()) -> None:
    """Register an external table if the catalog lacks it; files already at ``path`` are kept."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout} LOCATION '{path}'")
    if partition_by and path_exists(spark, path):
        spark.catalog.recoverPartitions(table)


def add_new_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Append the columns the table lacks; older rows read NULL there."""
    present = set(spark.table(table).columns)
    missing = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in present]
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(missing)})")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where(F.col("col_name") == "Location")
    return described.first()["data_type"]


def publish(
    df: DataFrame, table: str, base_path: str, partition_by: Sequence[str] = (), files: int | None = None, file_rows: int | None = None
) -> str:
    """Write a new version of a table beside the old one, then point the catalog at it.

    The input may read the table itself, since nothing is overwritten. An
    unpartitioned table changes over in one catalog step; a partitioned one is
    registered anew because its partitions carry locations of their own. ``files`` is the
    number of files of an unpartitioned table, ``file_rows`` the most rows of a file. Returns
    the new version's path; files of older versions stay.
    """
    spark = df.sparkSession
    path = f"{base_path.rstrip('/')}/v-{uuid.uuid4().hex}"
    limit = {"maxRecordsPerFile": file_rows} if file_rows else {}
    if partition_by:
        df.hint("rebalance", *partition_by).write.options(**limit).partitionBy(*partition_by).parquet(path)
    else:
        (df if files is None else df.repartition(files)).write.options(**limit).parquet(path)
    if spark.catalog.tableExists(table) and not partition_by:
        add_new_columns(spark, table, df.schema)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        # The table is external: dropping the name keeps the files.
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        ensure_table(spark, table, df.schema, path, partition_by)
    return path


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of several schema versions under one schema, absent columns as NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def register_external(spark: SparkSession, table: str, path: str) -> None:
    """Drop the name if taken and register the Parquet files at ``path`` under it."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="parquet")


def merge_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    changes: ChangeLog | None = None,
    from_files: bool = False,
) -> None:
    """Upsert into a partitioned catalog table, rewriting only the partitions touched.

    Source rows older by ``order_by`` than the table's are left out. In ``changes`` the merge notes
    what it will touch before it writes, and confirms that once its rows are in. Merges into one
    table run one after the other.

    A source ``from_files`` is made row by row from files that stay as they are meanwhile: every step
    reads the columns it needs from them. Any other source is written aside first.

    The partition columns must be functions of ``keys``, so that two versions of a row
    lie in the same partition. New columns are appended to the table. Rows are written
    aside and moved in at commit, partition by partition; loading the same source again
    leaves the same rows. Lost executors are harmless; should the driver die while it
    moves partitions, the one in hand is still in the staging folder of the write.
    """
    spark = source.sparkSession
    partition_by = partition_columns(spark, table)
    with scratch(spark, "merge") as keep:
        incoming = unique_rows(source, keys, order_by, keep, from_files)
        # Partition values only: as many rows as the increment touches partitions.
        touched = incoming.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_rows")).collect()
        if not touched:
            return
        add_new_columns(spark, table, source.schema)
        stored = spark.table(table)
        there = _of_partitions(stored, partition_by, touched)
        counts = there.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("n")).first()
        # Nothing to be looked up in partitions that are new.
        there = there if counts["n"] else stored.where(F.lit(False))
        load_id = changes.prepare(there, incoming, keys) if changes else None
        held, parts = bool(counts["n"]), math.ceil(((counts["most"] or 0) + max(row["_rows"] for row in touched)) / TASK_ROWS)
        if held and sum(row["_rows"] for row in touched) >= counts["n"]:
            # As in a load that is repeated: partitions of which no stored row stays are not read.
            alive = surviving(there, incoming, keys, order_by, partition_by, parts).collect()
            held, there = bool(alive), _of_partitions(stored, partition_by, alive)
        if held:
            merged = merged_rows(there, incoming, keys, order_by, partition_by, parts)
        else:
            merged = gathered(there.unionByName(incoming, allowMissingColumns=True), partition_by, len(touched))
        (
            merged.select(*stored.columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*partition_by)
            .parquet(table_location(spark, table))
        )
    add_partitions(spark, table, partition_by, touched)
    spark.catalog.refreshTable(table)
    if changes:
        changes.confirm(load_id)


def _of_partitions(stored: DataFrame, partition_by: Sequence[str], partitions: Sequence) -> DataFrame:
    tests = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in partition_by]) for row in partitions]
    return stored.where(reduce(lambda a, b: a | b, tests, F.lit(False)))


def gathered(rows: DataFrame, partition_by: Sequence[str], partitions: int) -> DataFrame:
    """Stored rows for a write by partition: shuffled unless the files they are read from hold few partitions each."""
    pieces = rows.select(F.spark_partition_id().alias("_task"), *partition_by).distinct().count()
    return rows if pieces <= FILES * partitions else rows.hint("rebalance", *partition_by)


def add_partitions(spark: SparkSession, table: str, partition_by: Sequence[str], touched: Sequence) -> None:
    """Register the touched partitions only; the table's folder is not listed."""
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    if any(row[c] is None for row in touched for c in partition_by):
        spark.catalog.recoverPartitions(table)
        return

    def literal(column: str, value) -> str:
        return f"{column} = " + (f"'{value}'" if isinstance(kinds[column], (T.StringType, T.DateType)) else str(value))

    specs = " ".join(f"PARTITION ({', '.join(literal(c, row[c]) for c in partition_by)})" for row in touched)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
