"""Exact ordered computations (positions, running sums, running maxima) that survive hot groups.

A plain window over `partitionBy(key)` sorts a whole key in one task. Here the order column is first
cut into ranges of about equal row count, the window runs inside (key, range), and one small row per
(key, range) carries the state of the earlier ranges forward. Results equal the plain window. Orders are
ascending and start with the column that was cut into ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import parallelism, stored

CHUNK = "_chunk"


def with_chunk(df: DataFrame, order: str, pieces: int | None = None, name: str = CHUNK) -> DataFrame:
    """Add an increasing range number over the numeric column `order`.

    The cut points are approximate quantiles, so every range holds about 1/pieces of the rows however the
    values are spread. They are taken once and become literals: every later use agrees on the ranges.
    """
    pieces = pieces or 4 * parallelism(df.sparkSession)
    accuracy = max(10_000, 10 * pieces)
    shares = ",".join(f"{i / pieces!r}D" for i in range(1, pieces))
    cuts = df.agg(
        F.expr(f"percentile_approx(cast(`{order}` as double), array({shares}), {accuracy})").alias("c")
    ).head()["c"]
    splits = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    if len(splits) == 2:
        return df.withColumn(name, F.lit(0.0))
    value = f"{name}_value"
    ranged = Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(
        # Nulls sort first, so they belong to the first range.
        df.withColumn(value, F.coalesce(F.col(order).cast("double"), F.lit(float("-inf"))))
    )
    return ranged.drop(value)


def _earlier(ends: DataFrame, keys: Sequence[str], chunk: str, state: Column, name: str) -> DataFrame:
    # One row per (key, range): at most `pieces` rows per key, so this window stays small.
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(*keys, chunk, state.over(before).alias(name))


def prefix_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    weight: Column,
    name: str,
    chunk: str = CHUNK,
) -> DataFrame:
    """Sum of `weight` over the rows of the key strictly before each row."""
    keys = list(keys)
    base = f"{name}_base"
    totals = df.groupBy(*keys, chunk).agg(F.sum(weight).alias(name))
    earlier = _earlier(totals, keys, chunk, F.sum(name), base)
    inside = (
        Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = df.withColumn(name, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    joined = _join(local, earlier, [*keys, chunk])
    return joined.withColumn(name, F.col(name) + F.coalesce(F.col(base), F.lit(0))).drop(base)


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "pos", chunk: str = CHUNK
) -> DataFrame:
    """Zero-based row number of each row in its key."""
    return prefix_sum(df, keys, order, F.lit(1).cast("bigint"), name, chunk)


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: Column,
    name: str,
    chunk: str = CHUNK,
    strict: bool = False,
) -> DataFrame:
    """Largest non-null `value` at or before each row (strictly before it with `strict`).

    With `value = struct(order..., payload)` this is the payload of the last row that has one.
    """
    keys = list(keys)
    base, column = f"{name}_base", f"{name}_value"
    marked = df.withColumn(column, value)
    ends = marked.groupBy(*keys, chunk).agg(F.max(column).alias(column))
    earlier = _earlier(ends, keys, chunk, F.max(column), base)
    inside = (
        Window.partitionBy(*keys, chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    )
    local = marked.withColumn(name, F.max(column).over(inside)).drop(column)
    joined = _join(local, earlier, [*keys, chunk])
    return joined.withColumn(name, F.greatest(name, base)).drop(base)


def _join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    # Null keys form a group of their own in a window, so they must also meet in the join.
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = None
    for column in on:
        same = F.col(column).eqNullSafe(F.col(f"_r_{column}"))
        condition = same if condition is None else condition & same
    return left.join(right, condition, "left").drop(*(f"_r_{c}" for c in on))


def rank_points(
    df: DataFrame, value: str, ranks: dict[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Exact order statistics per group: for each name, the value at the zero-based rank.

    `ranks` maps an output name to an expression over `n`, the group's row count. Equal values are counted
    before any sort, and each group is spread over value ranges, so no task sees a whole group.
    """
    by = list(by)
    # Read three times below, so the input is not.
    counted = stored(df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c")), "counted")
    ranged = with_chunk(counted, value)
    placed = prefix_sum(ranged, by, [value], F.col("_c"), "_before")
    totals = counted.groupBy(*by).agg(F.sum("_c").alias("n"))
    if by:
        placed = _join(placed, totals, by)
    else:
        placed = placed.withColumn("n", F.lit(totals.head()["n"]).cast("bigint"))
    picks = [
        F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c")), F.col(value))).alias(name)
        for name, rank in ranks.items()
    ]
    return placed.groupBy(*by).agg(*picks)
