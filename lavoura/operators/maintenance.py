"""Table maintenance: file statistics, health rules, compaction and analysis."""

from __future__ import annotations

import logging
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import partition_columns, publish, table_location
from .packing import pack_small_files

log = logging.getLogger(__name__)

# Limits of the health rules and the compaction targets.
MAX_FILES = 1000
MIN_MEAN_MB = 10
MAX_PARTITIONS = 1000
SILVER_TARGET_BYTES = 100 * 1024 * 1024
GOLD_TARGET_BYTES = 50 * 1024 * 1024
MB = 1024 * 1024


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every Parquet file below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )


def file_health(files: DataFrame, table: Column) -> DataFrame:
    """Files, size and the health issues of each table."""
    sized = files.groupBy(table.alias("table_name")).agg(
        F.count(F.lit(1)).alias("files_count"), F.sum("bytes").alias("total_bytes")
    )
    mean_mb = F.col("total_bytes") / MB / F.col("files_count")
    issues = F.filter(
        F.array(
            F.when(F.col("files_count") > MAX_FILES, "many_files"),
            F.when(mean_mb < MIN_MEAN_MB, "small_files"),
        ),
        lambda issue: issue.isNotNull(),
    )
    return sized.select(
        "table_name",
        "files_count",
        (F.col("total_bytes") / MB).alias("total_size_mb"),
        mean_mb.alias("mean_file_mb"),
        F.array_join(issues, ",").alias("issues"),
        (F.size(issues) > 0).alias("needs_optimization"),
    )


def tables_in(spark: SparkSession, databases: list[str]) -> list[str]:
    return [
        f"{db}.{t.name}" for db in databases if spark.catalog.databaseExists(db) for t in spark.catalog.listTables(db) if not t.isTemporary
    ]


def table_health(spark: SparkSession, table: str) -> DataFrame:
    return file_health(data_files(spark, table_location(spark, table)), F.lit(table))


def partition_report(spark: SparkSession, table: str, below: int = 1000) -> DataFrame:
    """Number of partitions, whether there are too many, and how many are small."""
    sizes = spark.table(table).groupBy(*partition_columns(spark, table)).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("partitions"),
        (F.count(F.lit(1)) > MAX_PARTITIONS).alias("too_many"),
        F.count_if(F.col("n") < below).alias("small_partitions"),
    )


def compact(spark: SparkSession, table: str, target_bytes: int = SILVER_TARGET_BYTES) -> str:
    """Rewrite a table into files of about ``target_bytes`` and swap it in.

    New versions go to a folder beside the original one, never inside it. Meant for
    tables written by batch jobs, which append to wherever the catalog points.
    """
    location = table_location(spark, table)
    size = data_files(spark, location).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    files = max(1, math.ceil(size / target_bytes))
    # A partition's rows are cut into files of the target size by their mean width.
    rows = spark.table(table).count()
    file_rows = max(1, rows * target_bytes // size) if size and partition_columns(spark, table) else None
    versioned = re.search(r"/v-[0-9a-f]{32}/?$", location)
    base = location[: versioned.start()] if versioned else f"{location.rstrip('/')}-versions"
    return publish(spark.table(table), table, base, partition_columns(spark, table), files, file_rows)


def analyze(spark: SparkSession, table: str) -> None:
    """Refresh the statistics the optimizer uses (it keeps none for struct columns)."""
    plain = [f"`{f.name}`" for f in spark.table(table).schema.fields if not isinstance(f.dataType, T.StructType)]
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(plain)}")


def optimize_listed(spark: SparkSession, tables: list[str], target_bytes: int = SILVER_TARGET_BYTES) -> dict[str, DataFrame]:
    """Compact every listed table and give its rows and applicants afterwards."""
    counts = {}
    for table in tables:
        compact(spark, table, target_bytes)
        counts[table] = spark.table(table).agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("total_records"),
            F.count_distinct("proponente_id").alias("unique_proponentes"),
        )
    return counts


def target_size(table: str) -> int:
    return GOLD_TARGET_BYTES if table.startswith("gold.") else SILVER_TARGET_BYTES


def _compacted(spark: SparkSession, table: str, target_bytes: int) -> None:
    """Pack the small files of a partitioned table in place; swap in a rewritten version of another."""
    if partition_columns(spark, table):
        pack_small_files(spark, table, data_files(spark, table_location(spark, table)), target_bytes)
    else:
        compact(spark, table, target_bytes)


def optimize_tables(spark: SparkSession, tables: list[str], target_bytes: int | None = None) -> DataFrame:
    """Check every table, compact and analyze the unhealthy ones; one report row each.

    Files are to have ``target_bytes``, or else what the table's layer asks for. The report has
    the number of partitions and whether they are too many. A table that fails is reported and
    the others go on.
    """
    lines = []
    for table in tables:
        try:
            health = table_health(spark, table).first()
            unhealthy = bool(health and health["needs_optimization"])
            if unhealthy:
                _compacted(spark, table, target_bytes or target_size(table))
                analyze(spark, table)
            parts = partition_report(spark, table).first() if partition_columns(spark, table) else None
            counted = (parts["partitions"], parts["too_many"]) if parts else (None, None)
            lines.append((table, unhealthy, health["issues"] if health else "", None, *counted))
        except Exception as error:  # one broken table must not stop the round
            log.exception("maintenance of %s failed", table)
            lines.append((table, False, "", str(error).splitlines()[0], None, None))
    schema = "table_name string, optimized boolean, issues string, error string, partitions long, too_many_partitions boolean"
    return spark.createDataFrame(lines, schema)
