"""Benchmark passages in documents by winnowing.

Of each run of ``width`` words, the fingerprint is the smallest hash among its runs of GRAM words.
Equal windows have equal fingerprints, so comparing fingerprints misses no shared span of
``width`` words or more; neighbouring windows mostly share theirs, so few are kept. The
fingerprints of the benchmark make a bit filter of bounded size. Documents keep the windows whose
fingerprint may be among them; these hits are extended to the whole window, by a join with the
benchmark's windows on 128 bits of hash.

An item with fewer words than ``width`` is one window of its own length, with fingerprints of
that length on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.common import WORDS, mixed, rolling, staged, text_bytes
from lavoura.llm.filters import BitFilter, bit_filter

#: Words of the hashed runs among which a window's smallest is its fingerprint.
GRAM = 5
#: Words looked at together.
BLOCK_WORDS = 1 << 18

# Words are runs of ASCII digits, letters in lower case and anything that is not ASCII.
_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_FOLD = bytes(c if c in _KEEP else 0x20 for c in bytes(range(0x100)).lower())

_CANDIDATES = pa.list_(pa.struct([("length", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("at", pa.int64())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of every run of ``length`` words, from the words' hashes."""
    gram = min(GRAM, length)
    runs = rolling(hashes, gram)
    out = runs[: max(0, len(hashes) - length + 1)].copy()
    for i in range(1, length - gram + 1):
        np.minimum(out, runs[i : i + len(out)], out=out)
    # Windows of different lengths have nothing to do with each other.
    return out ^ np.uint64(length * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def whole_keys(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for every run of ``length`` words."""
    return rolling(hashes, length), rolling(mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93)), length)


def _blocks(ids: list, texts: list[bytes]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, word counts, hashes of all words) of some rows at a time."""
    held, sizes, hashes, total = [], [], [], 0
    for row, text in zip(ids, texts, strict=True):
        words = words_of(text)
        held.append(row)
        sizes.append(len(words))
        hashes.append(WORDS.of(words))
        total += len(words)
        if total >= BLOCK_WORDS:
            yield held, np.array(sizes, np.int64), np.concatenate(hashes)
            held, sizes, hashes, total = [], [], [], 0
    if held:
        yield held, np.array(sizes, np.int64), np.concatenate(hashes)


def _item_windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            hashes = WORDS.of(words_of(text))
            if not len(hashes):
                continue
            length = min(width, len(hashes))
            prints, (low, high) = fingerprints(hashes, length), whole_keys(hashes, length)
            n = len(prints)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([item] * n, pa.string()),
                    pa.array([length] * n, pa.int32()),
                    pa.array(prints.view(np.int64)),
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                ],
                ["item", "length", "print", "low", "high"],
            )


def _hits(batches: Iterator[pa.RecordBatch], lengths: list[int], known: BitFilter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for ids, sizes, hashes in _blocks(part.column(0).to_pylist(), text_bytes(part.column(1))):
                starts = np.cumsum(sizes) - sizes
                doc = np.repeat(np.arange(len(sizes)), sizes)
                left = (starts + sizes)[doc] - np.arange(len(hashes))  # words from here to the end of the document
                found = []
                for length in lengths:
                    prints = fingerprints(hashes, length)
                    places = np.flatnonzero(left[: len(prints)] >= length)
                    places = places[known.holds(prints[places])]
                    if len(places):
                        low, high = whole_keys(hashes, length)
                        found.append((places, np.full(len(places), length), low[places], high[places]))
                place, size, low, high = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 4
                order = np.argsort(place, kind="stable")
                place = place[order]
                flat = pa.StructArray.from_arrays(
                    [
                        pa.array(size[order], pa.int32()),
                        pa.array(low[order].astype(np.uint64).view(np.int64)),
                        pa.array(high[order].astype(np.uint64).view(np.int64)),
                        pa.array(place - starts[doc[place]] if len(place) else place, pa.int64()),
                    ],
                    fields=list(_CANDIDATES.value_type),
                )
                bounds = np.searchsorted(place, np.append(starts, len(hashes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat).cast(_CANDIDATES)],
                    ["doc_id", "n_words", "found"],
                )


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words under the windows of each document."""
    for batch in batches:
        counts = []
        for spans in batch.column(1):
            at, length = (spans.values.field(f).to_numpy() for f in ("at", "length"))
            order = np.argsort(at, kind="stable")
            start, end = at[order], (at + length)[order]
            before = np.concatenate(([0], np.maximum.accumulate(end)[:-1]))
            counts.append(int(np.maximum(0, end - np.maximum(start, before)).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["row", "n_hit"])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``.

    Words are runs of ASCII letters and digits and of characters that are not ASCII, A-Z in lower
    case. A window is ``width`` consecutive words of a benchmark item; an item of fewer words, but
    not none, is one window. A word of a document is hit when it lies in an occurrence of any
    window. n_items counts the items that have an occurring window; the digest is the lower-case
    hex SHA-256 of their ids, sorted as strings and joined by commas.

    Null and empty texts have no words. Rows that repeat an item id are one item; the windows of an
    item without id hit, but it is neither counted nor in the digest. Rows of ``docs`` are judged one
    by one, whether they repeat an id or have none. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    owners = staged(
        items.mapInArrow(lambda it: _item_windows(it, width), "item string, length int, print long, low long, high long").distinct(),
        "winnow-items",
    )
    windows = staged(owners.select("length", "low", "high").distinct(), "winnow-windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # width of them at most
    prints = owners.select("print").distinct()
    known = docs.sparkSession.sparkContext.broadcast(bit_filter(prints, prints.count()))

    shape = "doc_id long, n_words long, found array<struct<length: int, low: long, high: long, at: long>>"
    looked = docs.mapInArrow(lambda it: _hits(it, lengths, known.value), shape)
    looked = staged(looked.withColumn("row", F.monotonically_increasing_id()), "winnow-looked")

    hits = looked.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    hits = staged(hits.join(windows, ["length", "low", "high"]), "winnow-hits")
    covered = (
        hits.groupBy("row").agg(F.collect_list(F.struct("at", "length")).alias("spans"))
        .mapInArrow(_covered, "row long, n_hit long")
    )
    named = owners.where("item is not null").select("length", "low", "high", "item")
    per_item = hits.select("row", "length", "low", "high").distinct().join(named, ["length", "low", "high"]).select("row", "item").distinct()
    of_items = per_item.groupBy("row").agg(
        F.count("*").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256")
    )
    found = staged(covered.join(of_items, "row", "left"), "winnow-found")
    return (
        looked.select("row", "doc_id", "n_words")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )
