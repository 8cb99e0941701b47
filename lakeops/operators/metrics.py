"""Pipeline metrics: latency statistics, percentiles, moving windows, consumer rates, write throughput."""

from __future__ import annotations

import time as clock
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.ordered import rank_points, running_max, with_chunk, with_position

# Histogram bounds in milliseconds and reported percentiles.
LATENCY_BOUNDS = (0, 10, 50, 100, 500, 1000)
PERCENTILES = (50, 90, 95, 99)


def bucket_label(value: str, bounds: Sequence[int] = LATENCY_BOUNDS) -> Column:
    label = F.when(F.col(value) >= bounds[-1], f"{bounds[-1]}+").when(F.col(value) < bounds[0], f"<{bounds[0]}")
    for low, high in zip(bounds[:-1], bounds[1:]):
        label = label.when((F.col(value) >= low) & (F.col(value) < high), f"{low}-{high}")
    return label


def latency_histogram(
    df: DataFrame, value: str, bounds: Sequence[int] = LATENCY_BOUNDS, by: Sequence[str] = ()
) -> DataFrame:
    """Count and share per latency bucket, values below the first bound included; empty buckets are listed with zero."""
    by = list(by)
    # One conditional count per bucket: a single row per group, so empty buckets need no join.
    edges = list(zip(bounds, [*bounds[1:], None]))
    counts = {
        (f"{low}-{high}" if high is not None else f"{low}+"): F.count_if(
            (F.col(value) >= low) & ((F.col(value) < high) if high is not None else F.lit(True))
        )
        for low, high in edges
    }
    counts[f"<{bounds[0]}"] = F.count_if(F.col(value) < bounds[0])
    wide = df.groupBy(*by).agg(F.count(value).alias("_n"), *(c.alias(n) for n, c in counts.items()))
    long = wide.unpivot([*by, "_n"], list(counts), "bucket", "messages")
    share = F.round(F.try_divide(F.col("messages") * 100.0, F.col("_n")), 4)
    return long.select(*by, "bucket", "messages", share.alias("percent"))


def latency_stats(df: DataFrame, value: str, time: str, by: Sequence[str] = (), recent_seconds: int = 10) -> DataFrame:
    """Count, mean, exact median, extremes, and message rates over all time and over the last seconds."""
    by = list(by)
    last = df.agg(F.max(time).alias("t")).head()["t"]
    seconds = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    recent = F.col(time) > F.lit(last) - F.expr(f"interval {recent_seconds} seconds")
    stats = df.groupBy(*by).agg(
        F.count(value).alias("messages"),
        F.round(F.avg(value), 6).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.round(F.try_divide(F.count(value), F.max(seconds) - F.min(seconds)), 6).alias("rate_per_s"),
        F.round(F.count_if(recent) / recent_seconds, 6).alias("recent_rate_per_s"),
    )
    middles = rank_points(
        df, value, {"_lo": F.floor((F.col("n") - 1) / 2), "_hi": F.floor(F.col("n") / 2)}, by
    )
    middles = middles.select(*by, F.round((F.col("_lo") + F.col("_hi")) / 2, 6).alias("median"))
    return _side_by_side(stats, middles, by)


def outliers(df: DataFrame, value: str, threshold: float) -> DataFrame:
    return df.filter(F.col(value) > threshold)


def latency_summary(
    df: DataFrame, value: str, by: Sequence[str] = (), duration_s: float | None = None
) -> DataFrame:
    """Count, min, max, mean and percentiles at index floor(n * p) of the sorted values; qps over `duration_s`."""
    by = list(by)
    stats = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(value).alias("queries"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.round(F.avg(value), 6).alias("mean"),
    )
    if duration_s:
        stats = stats.withColumn("qps", F.round(F.col("queries") / duration_s, 6))
    ranks = {f"p{p}": F.floor(F.col("n") * F.lit(p / 100)) for p in PERCENTILES}
    return _side_by_side(stats, rank_points(df, value, ranks, by), by)


def _side_by_side(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    if by:
        renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
        match = None
        for c in by:
            same = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
            match = same if match is None else match & same
        return left.join(renamed, match).drop(*(f"_r_{c}" for c in by))
    # Both sides are one global row; a constant key joins them.
    return left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one").drop("_one")


#: Size of a quantile sketch: its ranks are off by at most about 0.25 % of the rows (99 times of 100), however many sketches were merged.
SKETCH_SIZE = 2000
SKETCH_ERROR = 0.0025


def sketch_columns(value: str, k: int = SKETCH_SIZE) -> list[Column]:
    """Figures of a group that merge: messages, total, min, max and a quantile sketch."""
    x = F.col(value).cast("double")
    return [
        F.count(value).alias("messages"), F.sum(x).alias("total"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"),
    ]


def merged_windows(windows: DataFrame, window: str = "1 day", by: Sequence[str] = ()) -> DataFrame:
    """Longer windows from shorter ones (see `sketch_columns`), whose raw values are not needed any more."""
    return windows.groupBy(F.window("start", window), *by).agg(
        F.sum("messages").alias("messages"), F.sum("total").alias("total"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    ).select("window.start", "window.end", *by, "messages", "total", "min", "max", "sketch")


def sketch_figures(windows: DataFrame, percentiles: Sequence[int] = PERCENTILES) -> DataFrame:
    """Mean and percentiles of windows; a percentile's rank is off by at most about `SKETCH_ERROR` of the rows."""
    points = {f"p{p}": F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100)) for p in percentiles}
    filled = F.col("messages") > 0
    return windows.withColumns({"mean": F.try_divide(F.col("total"), F.col("messages")), **{n: F.when(filled, c) for n, c in points.items()}}).drop("sketch", "total")


def top_groups(df: DataFrame, by: Sequence[str], k: int = 10) -> DataFrame:
    """The k groups with most rows; ties by group value."""
    return df.groupBy(*by).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), *by).limit(k)


def moving_latency(
    df: DataFrame, value: str, order: Sequence[str], keep: Sequence[str], size: int = 1000, block: int = 20_000
) -> DataFrame:
    """Statistics over each row and the `size - 1` rows before it.

    Rows get their global position, then blocks of fixed row count; each block also receives the last
    `size - 1` rows of the one before, so blocks are independent and never larger than block + size.
    """
    block = max(block, size)
    ranged = with_chunk(df.select(*dict.fromkeys([*keep, *order, value])), order[0])
    placed = with_position(ranged, [], order).drop("_chunk")
    tail = F.col("pos") % block >= block - (size - 1)
    home = F.floor(F.col("pos") / block)
    copies = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    spread = placed.withColumn("_block", F.explode(copies))
    fields = [spread.schema[c] for c in keep]
    out = T.StructType(
        [
            *fields,
            T.StructField("count", T.LongType()),
            *(T.StructField(n, T.DoubleType()) for n in ("min", "max", "mean", *(f"p{p}" for p in PERCENTILES))),
        ]
    )

    def windows(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        home_first = int(key[0]) * block
        halo = int((rows["pos"] < home_first).sum())
        if halo == len(rows):
            return pd.DataFrame({f.name: [] for f in out.fields})
        values = rows[value].to_numpy(dtype=float)
        padded = np.concatenate([np.full(size - 1 - halo, np.inf), values])
        view = np.lib.stride_tricks.sliding_window_view(padded, size)
        counts = np.minimum(rows["pos"].to_numpy()[halo:] + 1, size)
        parts = []
        for start in range(0, len(view), 1000):
            part = np.sort(view[start : start + 1000], axis=1)
            n = counts[start : start + 1000]
            at = np.arange(len(part))
            total = np.where(np.isinf(part), 0.0, part).sum(axis=1)
            columns = [part[:, 0], part[at, n - 1], total / n]
            columns += [part[at, (n * p / 100).astype(int)] for p in PERCENTILES]
            parts.append(np.stack(columns, axis=1))
        stats = np.concatenate(parts)
        result = rows.iloc[halo:][list(keep)].reset_index(drop=True)
        result["count"] = counts
        for i, name in enumerate(("min", "max", "mean", *(f"p{p}" for p in PERCENTILES))):
            result[name] = stats[:, i]
        return result[out.fieldNames()]

    return spread.groupBy("_block").applyInPandas(windows, out)


def consumer_rate(
    samples: DataFrame,
    keys: Sequence[str] = ("topic", "partition"),
    order: Sequence[str] = ("sample_s",),
    offset: str = "current_offset",
    end: str = "log_end",
) -> DataFrame:
    """Offset difference to the previous sample of the same partition, with lag and rate per second.

    `order[0]` is the sample time in seconds. A falling offset (reset) counts as 0; `-` on either side means
    unassigned; the first sample has no rate yet.
    """
    ranged = with_chunk(samples, order[0])
    state = F.struct(*(F.col(c) for c in order), F.col(offset).alias("offset"))
    joined = running_max(ranged, list(keys), list(order), state, "_prev", strict=True).drop("_chunk")
    current = F.expr(f"try_cast(`{offset}` as bigint)")
    before = F.expr("try_cast(_prev.offset as bigint)")
    delta = F.greatest(current - before, F.lit(0))
    status = (
        F.when(F.col(offset) == "-", "unassigned")
        .when(F.col("_prev").isNull(), "pending")
        .when(F.col("_prev.offset") == "-", "unassigned")
        .otherwise("ok")
    )
    elapsed = F.col(order[0]) - F.col(f"_prev.{order[0]}")
    return joined.withColumns(
        {
            "status": status,
            "delta": F.when(status == "ok", delta),
            "rate_per_s": F.when(status == "ok", F.round(F.try_divide(delta.cast("double"), elapsed.cast("double")), 6)),
            "lag": F.col(end) - current,
        }
    ).drop("_prev")


def write_throughput(stats: DataFrame) -> DataFrame:
    """Totals over bulk-write batch statistics (`partition, batch, docs, ok, failed, seconds`)."""
    workers = stats.groupBy("partition").agg(
        F.sum("docs").alias("docs"), F.sum("ok").alias("ok"), F.sum("failed").alias("failed"), F.sum("seconds").alias("seconds")
    )
    return workers.agg(
        F.sum("docs").alias("docs"),
        F.sum("ok").alias("ok"),
        F.sum("failed").alias("failed"),
        F.round(F.avg("seconds"), 6).alias("mean_worker_seconds"),
        F.round(F.try_divide(F.sum("ok").cast("double"), F.max("seconds")), 3).alias("docs_per_s"),
    )


def batch_throughput(stats: DataFrame) -> DataFrame:
    """Documents per second of each batch."""
    return stats.withColumn("docs_per_s", F.round(F.try_divide(F.col("ok").cast("double"), F.col("seconds")), 3))


def timed_write(spark: SparkSession, name: str, write: Callable[[], None]) -> DataFrame:
    """Run a write and return one row (tablename, executiontime in seconds)."""
    started = clock.time()
    write()
    return spark.createDataFrame([(name, clock.time() - started)], "tablename string, executiontime double")
