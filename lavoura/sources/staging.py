"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the session names, or None when it names none."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at ``path`` on whatever storage it names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly in ``path``; none if it is not there."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(location)] if files.exists(location) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete what lies at ``path``, if anything does."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    This cuts lineage in a way that survives lost executors, keeps column pruning
    and pushdown for the readers, and gives the planner the true size, so a small
    table is broadcast because its size is known.

    The files stay until the checkpoint folder is cleaned, like Spark's own
    checkpoints; work that runs again and again uses ``scratch``.
    """
    return _written(df, work_folder(df.sparkSession, label))


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate results, such as a stream's output.

    It lies in the shared checkpoint folder. Only a session that runs on this machine
    alone may lack that setting.
    """
    root = checkpoint_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/lavoura/{label}-{uuid.uuid4().hex}"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="lavoura-")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Like ``staged`` for results that are not needed after the block, which removes its files."""
    folder = work_folder(spark, label)
    try:
        yield lambda df: _written(df, f"{folder}/{uuid.uuid4().hex}")
    finally:
        remove(spark, folder)
