"""Words, letters and hashes of Arrow text columns, a whole batch at a time.

A word is a run of bytes other than space and \\x09-\\x0D; in UTF-8 those bytes never occur inside another character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 22
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers as fractions in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, end to end, and the n + 1 row bounds in them. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with at most `limit` bytes of text each, or one row."""
    _, bounds = flat(batch.column(batch.schema.get_field_index(column)))
    row, n = 0, batch.num_rows
    while row < n:
        end = int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield batch.slice(row, end - row)
        row = end


class Words:
    """The words of a text column: byte `starts` and `ends` in `data`; row i has words first[i]:first[i + 1]."""

    def __init__(self, column: pa.Array):
        self.data, bounds = flat(column)
        n = len(self.data)
        inside = ~_SEPARATOR[self.data]
        opens = np.zeros(n + 1, bool)
        opens[1:n] = ~inside[:-1]
        opens[bounds] = True  # words end with their row
        opens[n] = True
        self.starts = np.flatnonzero(inside & opens[:-1])
        closes = opens[1:].copy()
        closes[: n - 1] |= ~inside[1:]
        self.ends = np.flatnonzero(inside & closes) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self._inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self):
            return np.zeros(0, np.uint64)
        begin = np.repeat(self.starts, np.diff(np.append(self.starts, len(self.data))))
        at = np.arange(self.starts[0], len(self.data)) - begin
        value = _BYTE[self.data[self.starts[0] :]]
        value *= powers(int(at.max()) + 1)[at]
        value[~self._inside[self.starts[0] :]] = 0
        sums = np.add.reduceat(value, self.starts - self.starts[0])
        return mix(sums + (self.ends - self.starts).astype(np.uint64) * np.uint64(_BASE))

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` consecutive word hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for power, i in zip(powers(size, 0xD6E8FEB86659FD93), range(size), strict=True):
        total += hashes[i : i + n] * power
    return mix(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct runs of `size` words as sorted hashes, and the n + 1 row bounds in them.

    A row with fewer words, but one at least, has one shingle: all its words.
    """
    hashes, first = words.hashes(), words.first
    n = len(first) - 1
    counts = np.diff(first)
    rows = words.row_of()
    values = windows(hashes, size)
    within = rows[: len(values)] == rows[size - 1 :][: len(values)]
    values, owners = values[within], rows[: len(values)][within]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        more = np.array([windows(hashes[first[r] : first[r + 1]], int(counts[r]))[0] for r in short], np.uint64)
        values, owners = np.concatenate([values, mix(more)]), np.concatenate([owners, short])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[fresh], owners[fresh]
    return values, np.searchsorted(owners, np.arange(n + 1))
