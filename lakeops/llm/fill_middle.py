"""Fill-in-middle documents: cut at drawn code points, found through memoised content-defined chunks.

A rolling hash over the last 32 bytes cuts texts into chunks of about 256 bytes, so equal passages give equal chunks wherever they stand. A task remembers, by a
chunk's whole content, its summary: number of code points, whether a marker lies inside, and the two bytes at either end, where a marker could go on in the
next chunk. The summaries of a text's chunks combine to its length, to whether it holds a marker, and, summed up, to the chunk that holds each cut; only there
are code points counted one by one. The memory of a task is bounded by bytes and starts anew when it is full; results do not depend on it.

Null texts are empty. A null doc_id draws as an empty number does. Empty texts, texts that hold a marker and the drawn share of plain ones stay as they are. Rows that repeat are
transformed alike. An empty table gives an empty result. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.text import flat, mix, powers, slices
from lakeops.llm.work import prepare

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode())
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20  # of 100
WINDOW, CHUNK_BITS, LONGEST = 32, 8, 4096
MEMORY = 16 << 20  # bytes of chunks a task remembers

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_SHAPE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each text's first byte, and at characters before which the window's hash says so.

    A window that reaches back into the text before never cuts. Longer runs without a cut are cut every `LONGEST` bytes or up to three before.
    """
    n = len(data)
    sums = np.cumsum(_BYTE[data] * powers(n, _INVERSE), dtype=np.uint64)
    window = sums[WINDOW - 1 :].copy()
    window[1:] -= sums[: n - WINDOW]
    window *= powers(n)[WINDOW - 1 :]
    cut = np.zeros(n + 1, bool)
    cut[WINDOW : n + 1] = mix(window) >> np.uint64(64 - CHUNK_BITS) == 0
    cut[:n] &= (data & 0xC0) != 0x80
    starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    early = (starts[:, None] + np.arange(WINDOW)).ravel()
    cut[early[early < n]] = False
    cut[starts] = True
    cut[n] = False
    at = np.flatnonzero(cut)
    gaps = np.diff(np.append(at, n))
    long = np.flatnonzero(gaps > LONGEST)
    if len(long):
        more = np.concatenate([np.arange(at[i] + LONGEST, at[i] + gaps[i], LONGEST) for i in long])
        for _ in range(3):
            more -= (data[more] & 0xC0) == 0x80
        at = np.union1d(at, more)
    return at


class Chunks:
    """Summaries of chunks by content."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held = memory, 0
        self.known: dict[bytes, tuple[int, bool]] = {}
        self.found = 0

    def summary(self, chunk: bytes) -> tuple[int, bool]:
        """Code points, and whether a marker lies inside. The dictionary compares whole contents."""
        known = self.known.get(chunk)
        if known is not None:
            self.found += 1
            return known
        known = len(chunk.decode()), any(m in chunk for m in MARKERS)
        if self.held > self.memory:
            self.known, self.held = {}, 0
        self.known[chunk] = known
        self.held += len(chunk)
        return known


def _cut(points: np.ndarray, at: int, starts: list[int], text: bytes) -> int:
    """The byte before which a text has `at` code points; `points` counts those before each chunk, and all of them at last."""
    chunk = int(np.searchsorted(points, at, "right")) - 1
    if chunk == len(points) - 1:
        return len(text)
    end = starts[chunk + 1] if chunk + 1 < len(starts) else len(text)
    inside = text[starts[chunk] : end].decode()
    return starts[chunk] + len(inside[: at - int(points[chunk])].encode())


def transform_text(text: bytes, starts: list[int], chunks: Chunks, draws: tuple[int, int, int, int]) -> tuple[int, str, int | None, int | None, bytes]:
    """Code points, form, code points of prefix and middle, and the text in that form."""
    points, marked, tail = np.zeros(len(starts) + 1, np.int64), False, b""
    for i, start in enumerate(starts):
        chunk = text[start : starts[i + 1] if i + 1 < len(starts) else len(text)]
        points[i + 1], inside = chunks.summary(chunk)
        seam = tail + chunk[:2]
        marked = marked or inside or any(m in seam for m in MARKERS)
        tail = (tail + chunk[-2:])[-2:]
    points = np.cumsum(points)
    n = int(points[-1])
    if not n or marked or draws[2] % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    first, second = _cut(points, a, starts, text), _cut(points, b, starts, text)
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if draws[3] % 100 < SUFFIX_FIRST_BELOW:
        return n, "spm", a, b - a, b"".join((MARKERS[1], suffix, MARKERS[0], prefix, MARKERS[2], middle))
    return n, "psm", a, b - a, b"".join((MARKERS[0], prefix, MARKERS[1], suffix, MARKERS[2], middle))


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunks = Chunks()
    for batch in batches:
        for some in slices(batch, "text"):
            data, bounds = flat(some.column(1))
            starts = chunk_starts(data, bounds) if len(data) >= WINDOW else bounds[:-1][bounds[:-1] < bounds[1:]]
            draws = [some.column(i).to_pylist() for i in range(2, 6)]
            first = np.searchsorted(starts, bounds)
            rows = []
            for i in range(some.num_rows):
                inside = (starts[first[i] : first[i + 1]] - bounds[i]).tolist()
                rows.append(transform_text(data[bounds[i] : bounds[i + 1]].tobytes(), inside, chunks, tuple(d[i] for d in draws)))
            n, form, prefix, middle, output = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def draw(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of seed, colon and document number."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(key, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Each document in its drawn form: doc_id, n (code points), form, prefix_chars, middle_chars (null if plain), output."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *draw(F.col("doc_id"), seed))
    return rows.mapInArrow(_transform, _SHAPE)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed: only plain texts can hold markers of their own."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix = F.when(form == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    suffix = F.when(form == "psm", F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))
