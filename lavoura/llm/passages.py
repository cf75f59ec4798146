"""Repeated word windows by level-wise doubling.

Windows of a short length are compared over all documents; where windows that repeat follow each
other at that length, and only there, the window of twice the length is formed and compared, and
so on up to the wanted length or until no candidate is left. The last level tells for every
candidate whether an equal window starts earlier.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.chunks import Chunk, Questions, answers, ask, each_chunk, packed
from lavoura.llm.common import WORDS, rolling

CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 32 << 20
#: Text per hash range of a level's questions.
RANGE_BYTES = 16 << 20


def levels(width: int, first: int) -> list[int]:
    """Lengths from about ``first`` to ``width``, each half the next one, rounded up."""
    out = [width]
    while math.ceil(out[0] / 2) >= first and out[0] > 1:
        out.insert(0, math.ceil(out[0] / 2))
    return out


class Windows:
    """The candidates of one chunk through the levels."""

    def __init__(self, chunk: Chunk, lengths: list[int], told: list[dict[int, bytes]], parts: int):
        self.words = [t.split() for t in chunk.texts()]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        hashes = np.concatenate([WORDS.of(w) for w in self.words]) if self.words else np.empty(0, np.uint64)
        ends = np.repeat(np.cumsum(self.sizes), self.sizes)
        places = np.arange(len(hashes))
        alive, before = None, 0
        for level, length in enumerate(lengths):
            fits = np.flatnonzero(places + length <= ends)
            if alive is not None:
                # Both ends of the longer window must repeat at the length before.
                fits = fits[alive[fits] & alive[fits + length - before]]
            self.starts = fits
            last = length == lengths[-1]
            self.questions = Questions(rolling(hashes, length)[fits], parts, last)
            if level >= len(told):
                break
            yes = self.questions.answered(told[level])
            if last:
                self.first_place = yes
                break
            yes |= self.questions.counts > 1
            alive = np.zeros(len(hashes), bool)
            alive[fits] = yes[self.questions.back]
            before = length

    def ranks(self, chunk: Chunk) -> np.ndarray:
        """The id of the document in which each distinct window first starts here."""
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        return chunk.order_ids[doc[self.starts[self.questions.first]]]

    def removed(self, width: int) -> np.ndarray:
        """Words covered by a window that also starts earlier."""
        back, first = self.questions.back, self.questions.first
        earliest = np.zeros(len(back), bool)
        earliest[first] = True
        bad = self.starts[~(earliest & self.first_place[back])]
        n = int(self.sizes.sum())
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, bad, 1)
        np.add.at(edges, bad + width, -1)
        return np.cumsum(edges[:-1]) > 0


def _asked(batches: Iterator[pa.RecordBatch], lengths: list[int], names: list[str], parts: int) -> Iterator[pa.RecordBatch]:
    for chunk, told in each_chunk(batches, names):
        w = Windows(chunk, lengths, told, parts)
        last = len(names) == len(lengths) - 1
        yield w.questions.rows(chunk.number, w.ranks(chunk) if last else None)


def _kept(batches: Iterator[pa.RecordBatch], lengths: list[int], names: list[str], parts: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for chunk, told in each_chunk(batches, names):
        w = Windows(chunk, lengths, told, parts)
        gone = w.removed(lengths[-1])
        removed, texts, digests, at = [], [], [], 0
        for words in w.words:
            mask = gone[at : at + len(words)]
            at += len(words)
            removed.append(int(mask.sum()))
            if removed[-1]:
                words = [x for x, m in zip(words, mask.tolist(), strict=True) if not m]
            kept = b" ".join(words)
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept)
        columns = [pa.array(chunk.ids, pa.int64()), pa.array(w.sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)]
        names_out = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
            names_out.append("kept_text")
        yield pa.RecordBatch.from_arrays(columns, names_out)


def without_repeats(
    docs: DataFrame, width: int = 20, first: int = 10, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for every row of ``docs``.

    Words are runs of anything but ASCII white space. A word goes if a window of ``width``
    consecutive words of its document covers it and the same words also start earlier: in a
    document with a smaller id, or earlier in this one. Windows are those of the input. The
    digest is that of the kept words, joined by one space, as UTF-8.

    Null and empty texts have no words. A null id counts as larger than all others; rows that
    repeat an id count as in the order of their chunks, an order that is fixed once the input
    is packed. Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks, total = packed(docs, CHUNK_BYTES, BUCKET_BYTES)
    parts = max(1, math.ceil(total / RANGE_BYTES))
    lengths, names = levels(width, first), []
    for length in lengths:
        asked = ask(chunks, lambda it, n=tuple(names): _asked(it, lengths, list(n), parts))
        last = length == lengths[-1]
        name = f"words_{length}"
        chunks = chunks.join(answers(asked, name, whole=last, ranked=last), "chunk", "left")
        names.append(name)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return chunks.mapInArrow(lambda it: _kept(it, lengths, names, parts, with_text), schema)
