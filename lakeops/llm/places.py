"""Exact places of rows in an order, without a task that holds all rows of a key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.work import stored


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tree: the task's number, and each row's place among the task's rows of its tree."""
    part, tree, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column(0).to_numpy(zero_copy_only=False)
        starts = np.append(0, np.flatnonzero(names[1:] != names[:-1]) + 1)
        sizes = np.diff(np.append(starts, len(names)))
        inside = np.arange(len(names)) - np.repeat(starts, sizes)
        if names[0] == tree:
            inside[: sizes[0]] += seen
        tree, seen = names[-1], int(inside[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(names), part, np.int32)), pa.array(inside.astype(np.int64))], names=[*batch.schema.names, "part", "inside"]
        )


def positioned(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Each row's place `idx` in its `tree` (a text, not null) by `order`, and `n`, the rows of the tree.

    Rows are dealt out by ranges, so no task holds a tree; equal rows are spread by their number in the input.
    """
    copies = "copy_number"
    keys = ["tree", *order, copies]
    sorted_rows = rows.withColumn(copies, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(copies)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = stored(sorted_rows.select(*rows.columns).mapInArrow(_numbered, f"{columns}, part int, inside long"), "placed")
    # One row per tree and task.
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("c"))
    of = Window.partitionBy("tree")
    before = F.coalesce(F.sum("c").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = stored(counts.select("tree", "part", before.alias("before"), F.sum("c").over(of).alias("n")), "places")
    return placed.join(counts, ["tree", "part"]).withColumn("idx", F.col("before") + F.col("inside")).drop("part", "inside", "before")
