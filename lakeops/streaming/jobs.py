"""Streaming jobs: change data into lake tables, document loads, latency windows."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.functions.jsonx import infer_schema
from lakeops.operators import cdc, docs, metrics, sinks
from lakeops.operators.tables import BUCKETS, BucketTable, CatalogTable, MergeOnReadTable


log = logging.getLogger("lakeops")


def checkpoint_path(root: str, job: str) -> str:
    """Checkpoint folder of a job: the same job name resumes where it stopped."""
    return f"{root.rstrip('/')}/checkpoint/{job}"


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run `handle(batch, batch_id)` per non-empty micro-batch; without an interval, process what is there and stop.

    An error in `handle` fails the query, so a batch is never skipped; the next start repeats it.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                handle(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.outputMode("append").foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def decoded_changes(
    batch: DataFrame, table: cdc.TableConfig, policy: str = "C", target_schema: T.StructType | None = None
) -> DataFrame:
    """Routed changes of one table from parsed events: `action`, `ts_ms` and the data columns.

    The schema is the configured one, or else what the whole batch holds; the columns the table already has keep
    their place and new ones follow.
    """
    mine = batch.filter((F.col("db") == table.db) & (F.col("table") == table.table))
    routed = cdc.route(mine, policy).select("action", "ts_ms", cdc.payload().alias("_data"))
    schema = table.schema
    if schema is None:
        found = infer_schema(routed, "_data", nulls=False)
        schema = found
        if target_schema is not None:
            hidden = {"ts_ms", "action"}
            known = T.StructType([f for f in target_schema.fields if f.name not in hidden])
            # A configured time column is text in the event and a timestamp in the table.
            known = T.StructType(
                [T.StructField(f.name, T.StringType()) if f.name in table.timestamp_fields else f for f in known.fields]
            )
            schema = cdc.merge_schemas(known, found)
    return cdc.coerce_timestamps(cdc.decode(routed, "_data", schema), table.timestamp_fields)


def change_order(changes: DataFrame, table: cdc.TableConfig) -> list[str]:
    """Event time first, then the configured precombine column, then all data as a last tie-break."""
    order = ["ts_ms"]
    if table.precombine_key and table.precombine_key in changes.columns:
        order.append(table.precombine_key)
    simple = [f.name for f in changes.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return order + [c for c in simple if c not in order and c != "action"]


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    tables: Sequence[cdc.TableConfig],
    lakes: Mapping[tuple[str, str], BucketTable | CatalogTable],
    fmt: str = "debezium",
    policy: str = "C",
    mode: str = "latest",
    at_once: int = 4,
    unrouted: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Apply one micro-batch of raw change events to the configured tables, `at_once` of them in parallel.

    A batch that comes again changes nothing, as a row never beats itself, whichever stream brings it.
    `unrouted` gets the events of tables that are not configured; without it their counts are logged.
    """
    parsed = cdc.with_source(cdc.parse_envelope(batch, fmt)).persist()

    def apply_one(table: cdc.TableConfig) -> None:
        lake = lakes[(table.db, table.table)]
        changes = decoded_changes(parsed, table, policy, lake.schema)
        if set(table.primary_key) <= set(changes.columns):
            lake.apply(changes, table.primary_key, change_order(changes, table), mode)
        elif not changes.isEmpty():  # an empty one has no column to know
            missing = sorted(set(table.primary_key) - set(changes.columns))
            raise ValueError(f"events of {table.db}.{table.table} have no key column {missing}, only {changes.columns}")

    try:
        strange = cdc.unrouted(parsed, tables)
        if unrouted:
            unrouted(strange, batch_id)
        else:
            for row in strange.groupBy("db", "table").count().limit(50).collect():
                log.warning("batch %s: %s events of %s.%s, which is not configured", batch_id, row["count"], row["db"], row["table"])
        # Tables are independent: several at a time keep the cluster busy while small ones commit.
        with ThreadPoolExecutor(max_workers=max(1, min(len(tables), at_once))) as pool:
            list(pool.map(apply_one, tables))
    finally:
        parsed.unpersist()


def start_cdc(
    stream: DataFrame,
    tables: Sequence[cdc.TableConfig],
    root: str,
    checkpoint: str,
    interval: str | None = None,
    fmt: str = "debezium",
    policy: str = "C",
    mode: str = "latest",
    lakes: Mapping[tuple[str, str], BucketTable | CatalogTable] | None = None,
    unrouted: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Keep one lake table per configured source table up to date from a stream with a `value` column.

    The targets are Parquet tables below `root`, foldered by key bucket and the configured partition columns, unless `lakes` names others, such as catalog tables.
    """
    lakes = lakes or open_tables(stream.sparkSession, tables, root)

    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, tables, lakes, fmt, policy, mode, unrouted=unrouted)

    return start(stream, handle, checkpoint, interval)


def open_tables(spark, tables: Sequence[cdc.TableConfig], root: str) -> dict[tuple[str, str], BucketTable]:
    return {
        (t.db, t.table): BucketTable(spark, f"{root}/{t.db}/{t.name}", t.primary_key, t.partition_by, t.buckets or BUCKETS, t.properties) for t in tables
    }


def start_merge_on_read(
    changes: DataFrame,
    table: MergeOnReadTable,
    checkpoint: str,
    compact_after: int = 3,
    interval: str | None = None,
) -> StreamingQuery:
    """Append routed changes (`action` plus data) as folders and fold a bucket's folders after every few of them."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, batch_id, F.col("action") == "delete", stream=checkpoint)
        table.compact(compact_after)

    return start(changes, handle, checkpoint, interval)


def start_load(
    actions: DataFrame,
    writer: Callable[[], docs.Writer],
    batch_size: int,
    report_path: str,
    checkpoint: str,
    dead_letter_path: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Bulk-write index actions of a file stream; the checkpoint makes a restart go on with unread files."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        docs.bulk_write(batch, writer, batch_size, f"{report_path}/batch={batch_id}", dead_letter_path)

    return start(actions, handle, checkpoint, interval)


def start_display(
    stream: DataFrame, checkpoint: str, rows: int = 20, interval: str | None = None, views: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None
) -> StreamingQuery:
    """Log the first rows of each micro-batch, or of each named view of it; a view that is ordered shows its least rows."""

    def show(batch: DataFrame, batch_id: int) -> None:
        for name, view in (views or {"": lambda rows: rows}).items():
            sinks.log_sample(view(batch), rows, f"batch {batch_id} {name}".strip())

    return start(stream, show, checkpoint, interval)


def keep_running(begin: Callable[[], StreamingQuery], failures: int = 2, pause_s: float = 0.0) -> int:
    """Run a stream to its end and start it again when it fails, until it has failed `failures` times in a row without a finished batch.

    Returns how often it was started. The failed batch is repeated by the next start, from the same checkpoint; the last failure is raised.
    """
    started = failed = 0
    while True:
        query = begin()
        started += 1
        try:
            query.awaitTermination()
            return started
        except StreamingQueryException:
            failed = 1 if query.lastProgress else failed + 1
            log.warning("stream %s failed (%s of %s)", query.name or query.id, failed, failures)
            if failed >= failures:
                raise
            time.sleep(pause_s)


def latency_windows(
    messages: DataFrame, event_time: str, latency_ms: str, window: str = "10 seconds", late: str = "1 minute"
) -> DataFrame:
    """Message count and latency figures per time window, dropping rows later than the watermark.

    In append mode a window comes out once, when the watermark has passed its end, and leaves the state.
    """
    return (
        messages.withWatermark(event_time, late)
        .groupBy(F.window(event_time, window))
        .agg(
            F.count("*").alias("messages"),
            F.avg(latency_ms).alias("mean"),
            F.min(latency_ms).alias("min"),
            F.max(latency_ms).alias("max"),
            F.percentile_approx(latency_ms, 0.5).alias("median"),
        )
        .select("window.start", "window.end", "messages", "mean", "min", "max", "median")
    )


def latency_sketches(
    messages: DataFrame, event_time: str, latency_ms: str, window: str = "1 hour", late: str = "1 minute", k: int = metrics.SKETCH_SIZE
) -> DataFrame:
    """Per time window the message count, extremes, sum and a mergeable sketch of the latencies; closed windows only, in append mode.

    `metrics.merged_windows` makes longer windows of them.
    """
    return (
        messages.withWatermark(event_time, late)
        .groupBy(F.window(event_time, window))
        .agg(*metrics.sketch_columns(latency_ms, k))
        .select("window.start", "window.end", "messages", "total", "min", "max", "sketch")
    )
