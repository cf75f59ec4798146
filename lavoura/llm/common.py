"""Helpers shared by the operators: staged tables, word hashes, linked components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a worker's cache holds, about, before it is emptied, and bytes of an entry besides its texts.
CACHE_BYTES, ENTRY_BYTES = 48 << 20, 200
#: The cache of this worker that is in use.
_CACHES: list[dict] = []


def in_use(cache: dict) -> None:
    """Empty the caches of other operators, which worker processes outlive, and give the memory back."""
    if _CACHES and _CACHES[-1] is cache:
        return
    for other in _CACHES:
        other.clear()
    _CACHES[:] = [cache]
    give_back()


def give_back() -> None:
    """Return to the system what this worker has freed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        # What the C library has freed stays with the process until it is told so.
        ctypes.CDLL(None).malloc_trim(0)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_lavoura_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='llm-')}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._lavoura_shipped = True


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only a session that runs on this machine alone may lack that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column) -> list[bytes]:
    """An Arrow text column as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast("binary").to_pylist()]


def blank_words(whole: bytes, utf8: bool = False) -> pa.Array:
    """The words of ``whole``, which ends with a blank, each with the blank that ends it."""
    ends = np.append(0, np.flatnonzero(np.frombuffer(whole, np.uint8) == 32) + 1)
    kind = pa.string() if utf8 else pa.binary()
    if len(whole) >> 31:
        kind = pa.large_string() if utf8 else pa.large_binary()
    else:
        ends = ends.astype(np.int32)
    return pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(whole)])


class WordCache(dict):
    """What is known of words (bytes), emptied when it holds too many bytes."""

    def __init__(self):
        super().__init__()
        self.held = 0

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def put(self, word: bytes, value):
        self.held += ENTRY_BYTES + len(word)
        if self.held > CACHE_BYTES:
            self.clear()
        self[word] = value
        return value


class WordHashes(WordCache):
    """64-bit hash of each word (bytes), computed once per worker."""

    def __missing__(self, word: bytes) -> int:
        return self.put(word, xxhash.xxh3_64_intdigest(word))

    def of(self, words: list[bytes]) -> np.ndarray:
        in_use(self)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORDS = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours, by doubling: about log2(width) passes."""
    if len(h) < width:
        return np.empty(0, np.uint64)
    base, power = 0x9E3779B97F4A7C15, 1
    out, done = None, 0  # hash of runs of `done` neighbours
    block, size = h, 1
    left = width
    while left:
        if left & 1:
            if out is None:
                out, done = block, size
            else:
                # runs of `done` followed by runs of `size`
                n = len(h) - done - size + 1
                out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + block[done : done + n]
                done += size
        left >>= 1
        if left:
            n = len(h) - 2 * size + 1
            power = pow(base, size, 1 << 64)
            block = block[:n] * np.uint64(power) + block[size : size + n]
            size *= 2
    return mixed(out)


def components(edges: DataFrame, label: str, rounds: int | None = None) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for every node in them.

    Alternates large-star and small-star steps on tables in the shared folder until nothing
    changes, so neither links nor components ever meet in one place. A star's centre is an
    aggregate with map-side partial results and is joined back from a staged table, a plain
    equi-join that adaptive execution can split when one centre has most of the links.

    With ``rounds``, stops after so many: nodes then have a smaller node of their component, and
    nodes of one component may still have several.
    """
    now = staged(
        edges.where("a != b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(),
        f"{label}-links",
    )

    def state(df):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")).alias("s")).first()
        return row["n"], row["s"]

    before, done = (1, 0) if rounds else state(now), 0
    while before[0] and done != rounds:
        done += 1
        # Large star: every larger neighbour is linked to the smallest neighbour (or the node itself).
        both = now.selectExpr("low u", "high v").union(now.selectExpr("high u", "low v"))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), f"{label}-large")
        now = both.where("v > u").join(least, "u").selectExpr("m low", "v high").where("low < high").distinct()
        now = staged(now, f"{label}-links")
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = staged(now.groupBy("high").agg(F.min("low").alias("m")), f"{label}-small")
        joined = now.join(least, "high")
        now = joined.selectExpr("m low", "low high").where("low < high").union(least.selectExpr("m low", "high")).distinct()
        now = staged(now, f"{label}-links")
        after = () if rounds else state(now)
        if after == before:
            break
        before = after or before
    # Every node now hangs on its component's smallest node (or, stopped early, on some smaller ones).
    hangs = now.selectExpr("high node", "low component")
    if rounds:
        return hangs.groupBy("node").agg(F.min("component").alias("component"))
    return hangs.union(now.selectExpr("low node", "low component").distinct())
