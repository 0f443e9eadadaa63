"""Words of Arrow text batches as numpy arrays.

Texts stay UTF-8 bytes. Every separator and every letter that is lowered is
ASCII, so bytes and code points agree on where words begin and end. A batch is
worked on in slices of a few megabytes; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

# Which bytes (after lowering) belong to a word.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NON_BLANK = np.ones(256, bool)
NON_BLANK[0x20] = NON_BLANK[0x09:0x0E] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads each input over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


@dataclass
class Words:
    """Words of a slice: ``first[d]:first[d+1]`` are those of document d."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def of_doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, the same in every batch."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        size = self.ends - self.starts
        begin = np.cumsum(size) - size
        at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(begin, size)
        source = at + np.repeat(self.starts, size)
        weight = stream(int(size.max()), 11)
        value = (self.data[source].astype(np.uint64) + np.uint64(1)) * weight[at]
        return mix(np.add.reduceat(value, begin) + size.astype(np.uint64))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0]:at[-1]]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with at most ``limit`` bytes of text, or one longer text."""
    offsets, data = texts(batch.column(column))
    row = 0
    while row < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = min(max(last, row + 1), batch.num_rows)
        at = offsets[row:last + 1]
        yield batch.slice(row, last - row), at - at[0], data[at[0]:at[-1]]
        row = last


def words(offsets: np.ndarray, data: np.ndarray, table: np.ndarray) -> Words:
    low = LOWER[data]
    inside = table[low]
    before = np.zeros(len(inside), bool)
    after = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(low, offsets, starts, ends, np.searchsorted(starts, offsets))


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from concatenated values."""
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
