"""Bit filters of bounded size over the keys of a table.

A filter says which keys a table surely does not hold, so that tasks need not send those to be
joined. Its size follows the number of keys up to a fixed bound; beyond that it passes more keys
that are not there, and the join that follows sorts these out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lavoura.llm.common import mixed

BITS_A_KEY = 16
#: Bits of the largest filter: 8 MB.
MOST_BITS = 1 << 26
_SLICE = 1 << 16


class BitFilter:
    """Bits, two for each key."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self._last = np.uint64(len(bits) * 8 - 1)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = mixed(keys)
        return x & self._last, (x >> np.uint64(32)) & self._last

    def _at(self, places: np.ndarray) -> np.ndarray:
        return (self.bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1

    def __contains__(self, key: int) -> bool:
        return bool(self.holds(np.array([key], np.uint64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each 64-bit key may be one of the table's."""
        first, second = self.places(keys)
        out = self._at(first).astype(bool)
        out[out] = self._at(second[out]).astype(bool)
        return out


def bit_filter(keys: DataFrame, n: int) -> BitFilter:
    """The filter of about ``n`` keys, the only column (long) of ``keys``; built by the executors."""
    size = 1 << 16
    while size < min(MOST_BITS, BITS_A_KEY * n):
        size *= 2

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on, places = np.zeros(size, bool), BitFilter(np.zeros(size // 8, np.uint8)).places
        for batch in batches:
            for part in places(batch.column(0).to_numpy().view(np.uint64)):
                on[part] = True
        packed = np.packbits(on, bitorder="little")
        for at in range(0, len(packed), _SLICE):
            part = packed[at : at + _SLICE]
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([at // _SLICE], pa.int32()), "bits": pa.array([part.tobytes()])})

    def united(table: pa.Table) -> pa.Table:
        rows = np.stack([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
        return table.slice(0, 1).set_column(1, "bits", pa.array([np.bitwise_or.reduce(rows, axis=0).tobytes()], pa.binary()))

    shape = "slice int, bits binary"
    out = np.zeros(size // 8, np.uint8)
    # Never more than size / 8 bytes, whatever the number of keys.
    for row in keys.mapInArrow(marked, shape).groupBy("slice").applyInArrow(united, shape).collect():
        part = np.frombuffer(row["bits"], np.uint8)
        out[row["slice"] * _SLICE :][: len(part)] = part
    return BitFilter(out)
