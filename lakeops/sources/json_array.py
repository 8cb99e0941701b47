"""One large JSON array read by many tasks.

A file is read in blocks, as text cut at `}` (so a file without line breaks has blocks, too). Where an element ends depends on all that comes before: on whether a
quote is open and on how deep brackets are nested. Both are states of an automaton whose effect over a block can be told without its start: the parity of
unescaped quotes, and for either start the change of depth and the commas at each relative depth. A first pass sums a block up to one
small row; a window over these rows gives each block its state and the number of its first element; a second pass cuts the elements. An element that lies
in several blocks is put together from one piece a block.

A file may also hold a single object, which is one element. Elements keep their text; white space around them goes. Brackets and quotes inside strings and escaped
quotes are text. Files are told apart by path; an empty file or array has no elements.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.jsonx import infer_schema
from lakeops.operators.cdc import expand_json
from lakeops.session import parallelism, part_count, stored

_QUOTE, _BACK, _COMMA, _CLOSE = b'"'[0], b"\\"[0], b","[0], b"}"[0]
_DEPTH = np.zeros(256, np.int8)
_DEPTH[list(b"[{")], _DEPTH[list(b"]}")] = 1, -1
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n\xef\xbb\xbf")] = True  # with the bytes of a byte-order mark


def _quotes(data: np.ndarray) -> np.ndarray:
    """Whether each byte is a quote that opens or closes a string. `data` starts behind a `}`, so nothing before it escapes."""
    quote = data == _QUOTE
    back = np.flatnonzero(data == _BACK)
    if len(back):
        first = np.flatnonzero(np.append(True, np.diff(back) > 1))
        lengths = np.diff(np.append(first, len(back)))
        ends = back[first] + lengths
        ends = ends[(lengths % 2 == 1) & (ends < len(data))]
        quote[ends] = False
    return quote


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, np.ndarray]]:
    """Consecutive rows of one block: its path and start, the first row, and the bytes with the `}` that ended each row put back."""
    n = batch.num_rows
    if not n:
        return
    path = batch.column(0).dictionary_encode().indices.to_numpy()
    block = batch.column(1).to_numpy()
    starts = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (block[1:] != block[:-1])))
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
        text = b"}".join(batch.column(2).slice(start, stop - start).to_pylist()) + b"}"
        yield (batch.column(0)[start].as_py(), int(block[start])), start, np.frombuffer(text, np.uint8)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: quotes (parity), change of depth and commas by relative depth for both starts, first character that is not blank."""

    def row(key, quotes, depth, commas, first) -> pa.RecordBatch:
        flat = [[(d, n) for d, n in sorted(c.items())] for c in commas]
        kinds = pa.list_(pa.struct([("depth", pa.int64()), ("n", pa.int64())]))
        lists = [pa.array([[{"depth": d, "n": n} for d, n in f]], kinds) for f in flat]
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([quotes], pa.int32()), pa.array([depth[0]], pa.int64()), pa.array([depth[1]], pa.int64()), *lists, pa.array([first], pa.string())],
            names=["path", "block", "quotes", "depth0", "depth1", "commas0", "commas1", "first"],
        )

    held = None
    for batch in batches:
        for key, _, data in _runs(batch):
            if held is None or held[0] != key:
                if held is not None:
                    yield row(*held)
                held = [key, 0, [0, 0], [{}, {}], None]
            parity = (np.cumsum(_quotes(data)) + held[1]) & 1
            steps = _DEPTH[data].astype(np.int64)
            for start in (0, 1):
                outside = parity == start
                depth = held[2][start] + np.cumsum(np.where(outside, steps, 0))
                levels, counts = np.unique(depth[outside & (data == _COMMA)], return_counts=True)
                for level, n in zip(levels.tolist(), counts.tolist(), strict=True):
                    held[3][start][level] = held[3][start].get(level, 0) + n
                held[2][start] = int(depth[-1])
            held[1] = int(parity[-1])
            if held[4] is None:
                seen = np.flatnonzero(~_BLANK[data])
                # The last row of a file may have no `}` of its own: a lone one tells nothing.
                held[4] = chr(data[seen[0]]) if len(seen) > 1 else None
    if held is not None:
        yield row(*held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements and pieces of blocks whose start is known."""

    def out(path, block, index, text, whole) -> pa.RecordBatch:
        n = len(index)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(index, pa.int64()), pa.array(text, pa.binary()).cast(pa.string()), pa.array(whole, pa.bool_())],
            names=["path", "block", "idx", "text", "whole"],
        )

    held = None  # key, open quote, depth, number of the open element, whether it began before, its bytes so far

    def end(held) -> Iterator[pa.RecordBatch]:
        yield out(held[0][0], held[0][1], [held[3]], [b"".join(held[5])], [False])

    for batch in batches:
        for key, row, data in _runs(batch):
            if held is None or held[0] != key:
                if held is not None:
                    yield from end(held)
                quoted, depth, index, top = (batch.column(i)[row].as_py() for i in range(3, 7))
                if quoted is None:
                    raise ValueError(f"block {key} was not there in the first pass: the files or the block size have changed")
                held = [key, quoted, depth, index, True, []]
            parity = (np.cumsum(_quotes(data)) + held[1]) & 1
            outside = parity == 0
            steps = np.where(outside, _DEPTH[data], 0).astype(np.int64)
            depth = held[2] + np.cumsum(steps)
            # The array's own brackets, and what follows the value, are not part of an element.
            hidden = ((steps == -1) & (depth < top)) | ((steps == 1) & (depth <= top) & (top == 1))
            shown = np.where(hidden, np.uint8(32), data)
            cuts = np.flatnonzero(outside & (data == _COMMA) & (depth == top)) if top else np.zeros(0, np.int64)
            index, text, whole, last = [], [], [], 0
            for cut in cuts.tolist():
                held[5].append(shown[last:cut].tobytes())
                index.append(held[3])
                text.append(b"".join(held[5]))
                whole.append(not held[4])
                held[3:] = [held[3] + 1, False, []]
                last = cut + 1
            held[5].append(shown[last:].tobytes())
            held[1], held[2] = int(parity[-1]), int(depth[-1])
            if index:
                yield out(*key, index, text, whole)
    if held is not None:
        yield from end(held)


def json_array_elements(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """The elements of JSON array files: path, idx (from 0), text. `block_bytes` is the size of a block, by default Spark's for files."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    # Both passes must see the same blocks, whatever the number of cores is by then.
    spark.conf.set(names[1], "1")
    if block_bytes:
        spark.conf.set(names[0], str(block_bytes))
    try:
        lines = spark.read.text(path, lineSep="}").select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
        )
        # A task takes many small blocks, one after the other.
        lines = lines.coalesce(part_count(spark.read.text(path), 4 * parallelism(spark)))
        level = "array<struct<depth: bigint, n: bigint>>"
        shape = f"path string, block long, quotes int, depth0 long, depth1 long, commas0 {level}, commas1 {level}, first string"
        sums = stored(lines.mapInArrow(_summaries, shape), "json-blocks")
        # One row of about 100 bytes a block, a millionth of the input. Only a broadcast keeps a block's rows in order.
        known = lines.join(F.broadcast(_starts(sums)), ["path", "block"], "left").select("path", "block", "value", "quoted", "depth", "idx", "top")
        pieces = stored(known.mapInArrow(_cut, "path string, block long, idx long, text string, whole boolean"), "json-pieces")
    finally:
        for n, value in before.items():
            if value is None:
                spark.conf.unset(n)
            else:
                spark.conf.set(n, value)
    # At most two pieces of a block are not whole.
    parts = pieces.filter("not whole").groupBy("path", "idx").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    joined = parts.select("path", "idx", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    found = pieces.filter("whole").select("path", "idx", "text").unionByName(joined)
    trimmed = found.withColumn("text", F.regexp_replace("text", r"^[\s\x{FEFF}]+|\s+$", ""))
    return trimmed.filter("text <> ''")


def _starts(sums: DataFrame) -> DataFrame:
    """Each block's state at its start: open quote, depth, number of the element that is open, and the depth of an element's commas."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row a block.
    known = sums.withColumns({
        "quoted": F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2,
        "top": F.when(F.first("first", ignorenulls=True).over(whole) == "[", 1).otherwise(0),
    })
    change = F.when(F.col("quoted") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    known = known.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0)))
    level = F.when(F.col("quoted") == 0, F.col("commas0")).otherwise(F.col("commas1"))
    mine = F.aggregate(level, F.lit(0).cast("long"), lambda n, x: n + F.when((x["depth"] + F.col("depth") == F.col("top")) & (F.col("top") == 1), x["n"]).otherwise(0))
    known = known.withColumn("commas", mine)
    known = known.withColumn("idx", F.coalesce(F.sum("commas").over(before), F.lit(0)))
    return stored(known.select("path", "block", F.col("quoted").cast("int").alias("quoted"), "depth", "idx", "top"), "json-starts")


def json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None, block_bytes: int | None = None) -> DataFrame:
    """The objects of JSON array files as rows; without a schema it is found in all of them. Elements that are no objects give nulls."""
    rows = json_array_elements(spark, path, block_bytes).select("text")
    if schema is None:
        schema = infer_schema(rows, "text")
    return expand_json(rows, "text", schema)
