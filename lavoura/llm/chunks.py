"""Documents packed into chunks, and questions about fingerprints that chunks ask each other.

A chunk is one row with some megabytes of whole texts. To find out which of its fingerprints
(of word windows, byte anchors, ...) other chunks have too, a chunk sends each distinct one
once, packed by hash range; the task of a range answers with one bit per question. What moves is
the fingerprints and one bit back, and however often a fingerprint occurs, its range receives it
once per chunk at most, so there are no hot keys.

Chunks are stored bucketed by their number, so that the answers are joined to them without
moving the texts again.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavoura.llm.common import shared_folder, staged, text_bytes

#: Stands for a null id in comparisons: after all others.
NO_ID = np.iinfo(np.int64).max


def packed(docs: DataFrame, chunk_bytes: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """(chunk, n_docs, ids, lengths, texts) over (doc_id, text), and the bytes of all texts."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, texts, size = 0, [], [], 0
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        squeeze = zstandard.ZstdCompressor(level=1)

        def row():
            order = sorted(range(len(ids)), key=lambda i: (NO_ID if ids[i] is None else ids[i]))
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([(task << 32) + made], pa.int64()),
                    "ids": pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
                    "lengths": pa.array([[len(texts[i]) for i in order]], pa.list_(pa.int64())),
                    "texts": pa.array([squeeze.compress(b"".join(texts[i] for i in order))], pa.binary()),
                }
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for doc, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1)), strict=True):
                    ids.append(doc)
                    texts.append(text)
                    size += len(text)
                    if size >= chunk_bytes:
                        yield row()
                        made, ids, texts, size = made + 1, [], [], 0
        if ids:
            yield row()

    chunks = docs.select("doc_id", "text").mapInArrow(pack, "chunk long, ids array<long>, lengths array<long>, texts binary")
    name = bucketed(chunks, max(1, math.ceil(total / bucket_bytes)))
    return spark.table(name), total


def bucketed(chunks: DataFrame, buckets: int) -> str:
    """The name of a table of ``chunks``, bucketed by their number, in the shared folder."""
    name = f"llm_chunks_{uuid.uuid4().hex}"
    (
        chunks.write.bucketBy(buckets, "chunk").option("path", shared_folder(chunks.sparkSession, "chunks"))
        .option("compression", "none").saveAsTable(name)
    )
    return name


def forget(spark: SparkSession, name: str) -> None:
    """Drop a table of ``bucketed`` and its files, once nothing reads it any more."""
    place = spark.sql(f"describe formatted {name}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"drop table {name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Chunk:
    """One chunk, unpacked: ``ids`` (None for null) and ``texts`` by ascending id."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.number = batch.column("chunk")[row].as_py()
        self.ids = batch.column("ids")[row].as_py()
        lengths = np.array(batch.column("lengths")[row].as_py(), np.int64)
        whole = zstandard.ZstdDecompressor().decompress(batch.column("texts")[row].as_py(), max_output_size=int(lengths.sum()) or 1)
        ends = np.cumsum(lengths)
        self.joined, self.lengths, self.ends = whole, lengths, ends
        self.order_ids = np.array([NO_ID if x is None else x for x in self.ids], np.int64)

    def texts(self) -> list[bytes]:
        return [self.joined[e - n : e] for e, n in zip(self.ends.tolist(), self.lengths.tolist(), strict=True)]


def each_chunk(batches: Iterator[pa.RecordBatch], answers: list[str]) -> Iterator[tuple[Chunk, list[dict[int, bytes]]]]:
    """Every chunk with the answers it got, one mapping of range to bits for each column named."""
    for batch in batches:
        for row in range(batch.num_rows):
            got = []
            for name in answers:
                told = batch.column(name)[row].as_py() or []
                got.append({x["part"]: x["bits"] for x in told})
            yield Chunk(batch, row), got


def range_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each 64-bit key."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


class Questions:
    """The distinct keys of a chunk by range: what it asks, and how answers map back.

    ``whole`` keys keep 64 bits; others 32 bits besides their range, which is enough for a
    filter whose survivors are looked at again. Without ``places`` there are no ``first`` ones.
    """

    def __init__(self, keys: np.ndarray, parts: int, whole: bool, places: bool = True):
        self.whole = whole
        part = range_of(keys, parts)
        code = keys if whole else (part << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        if whole or places:
            self.codes, self.first, self.back, self.counts = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
            part = part[self.first].astype(np.int64)
        else:
            # The sort need not be stable then, which is much quicker.
            self.codes, self.back, self.counts = np.unique(code, return_inverse=True, return_counts=True)
            part = (self.codes >> np.uint64(32)).astype(np.int64)
        # Ranges ascend with the codes.
        self.parts, self.starts = np.unique(part, return_index=True)
        self.bounds = np.append(self.starts, len(self.codes))

    def rows(self, chunk: int, order: np.ndarray | None = None) -> pa.RecordBatch:
        """One row per range; ``order`` ranks each key's first occurrence against other chunks."""
        spans = list(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True))
        keys = [(self.codes[a:b] if self.whole else self.codes[a:b].astype(np.uint32)).tobytes() for a, b in spans]
        orders = [None if order is None else order[a:b].tobytes() for a, b in spans]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.parts, pa.int64()), pa.array([chunk] * len(spans), pa.int64()), pa.array(keys, pa.binary()), pa.array(orders, pa.binary())],
            ["part", "chunk", "keys", "ranks"],
        )

    def answered(self, told: dict[int, bytes]) -> np.ndarray:
        """The answer to each distinct key, in the order of ``codes``."""
        out = np.zeros(len(self.codes), bool)
        for p, a, b in zip(self.parts.tolist(), self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True):
            out[a:b] = np.unpackbits(np.frombuffer(told[p], np.uint8), count=b - a).astype(bool)
        return out


ASK = "part long, chunk long, keys binary, ranks binary"


def _answer(table: pa.Table, whole: bool, ranked: bool) -> pa.Table:
    """For each key of each chunk: do other chunks have it; or, ranked, is this its first place?"""
    chunks, size = table.column("chunk").to_pylist(), 8 if whole else 4
    parts = table.column("part").to_pylist()
    raw = table.column("keys").to_pylist()
    lengths = np.array([len(x) // size for x in raw], np.int64)
    keys = np.frombuffer(b"".join(raw), np.uint64 if whole else np.uint32)
    if ranked:
        ranks = np.frombuffer(b"".join(table.column("ranks").to_pylist()), np.int64)
        owner = np.repeat(np.array(chunks, np.int64), lengths)
        order = np.lexsort((owner, ranks, keys))
    else:
        order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    bits = np.empty(len(keys), bool)
    if ranked:
        bits[order] = new
    else:
        alone = new.copy()
        alone[:-1] &= new[1:]
        bits[order] = ~alone
    ends = np.cumsum(lengths)
    out = [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "part": pa.array(parts, pa.int64()), "bits": pa.array(out, pa.binary())})


def answers(questions: DataFrame, name: str, whole: bool = False, ranked: bool = False) -> DataFrame:
    """(chunk, ``name``): all answers to a chunk's questions, staged."""
    told = questions.groupBy("part").applyInArrow(lambda t: _answer(t, whole, ranked), "chunk long, part long, bits binary")
    return staged(told.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias(name)), f"answers-{name}")


def ask(chunks: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    return chunks.mapInArrow(make, ASK)
