"""Streaming queries: `events` read as a file stream, processed to the end, and the tables they leave."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import bulk_sink, cdc, docs, metrics, sinks
from lakeops.operators.tables import MergeOnReadTable, is_folder
from lakeops.session import part_count, stored, table, work_path
from lakeops.sources.readers import file_stream
from lakeops.streaming import jobs, state
from lakeops.workloads import change_data as cd
from lakeops.workloads import documents, operations
from lakeops.workloads import lineage as lineage_queries


def _event_stream(spark: SparkSession, sf: str, name: str = "events") -> DataFrame:
    schema = table(spark, sf, name).schema
    path = f"{sf}/{name}.parquet"
    if is_folder(spark, path):
        return file_stream(spark, path, "parquet", schema)
    return file_stream(spark, sf, "parquet", schema, pathGlobFilter=f"{name}.parquet")


def cdc_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Four tables of two databases kept from one stream of raw change events."""
    root = work_path(spark, "stream-cdc")
    stream = cd.change_events(_event_stream(spark, sf))
    jobs.start_cdc(stream, cd._TABLES, root, jobs.checkpoint_path(root, "cdc")).awaitTermination()
    lakes = jobs.open_tables(spark, cd._TABLES, root)
    parts = [
        lake.snapshot().select(F.lit(db).alias("db"), F.lit(name).alias("table"), "user_id", "event_id", "event_type")
        for (db, name), lake in lakes.items()
        if lake.schema is not None
    ]
    return reduce(DataFrame.unionByName, parts)


def merge_on_read(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "stream-mor")
    parsed = cdc.route(cdc.parse_envelope(cd.change_events(_event_stream(spark, sf))), "C")
    changes = cdc.decode(parsed.select("ts_ms", "action", cdc.payload().alias("d")), "d", cd._PAYLOAD)
    lake = MergeOnReadTable(spark, f"{root}/table", ["user_id"], ["ts_ms", "event_id"])
    jobs.start_merge_on_read(changes, lake, jobs.checkpoint_path(root, "mor"), compact_after=1).awaitTermination()
    return lake.snapshot().select("user_id", "event_id", "event_type", "value")


def document_load(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "stream-load")
    rows = _event_stream(spark, sf, "documents").select(F.col("doc_id").alias("doc_key"), "lang", "n_chars", "text")
    actions = docs.bulk_actions(rows, sinks.index_name("docs-{lang}-v1"))
    # The second start finds nothing new, so nothing is sent twice.
    for _ in range(2):
        jobs.start_load(
            actions, documents._Picky(), 1, f"{root}/report", jobs.checkpoint_path(root, "load")
        ).awaitTermination()
    stats = spark.read.schema(docs.STATS).option("basePath", f"{root}/report").parquet(f"{root}/report")
    return stats.agg(F.sum("docs").alias("docs"), F.sum("ok").alias("ok"), F.sum("failed").alias("failed"))


def document_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Documents loaded by the sink, a micro-batch a load; the second start finds nothing new."""
    path, checkpoint = work_path(spark, "bulk"), work_path(spark, "marks")
    rows = _event_stream(spark, sf, "documents").select(F.col("doc_id").alias("doc_key"), "lang", "n_chars", "text")
    actions = docs.bulk_actions(rows, sinks.index_name("docs-{lang}-v1"))
    for _ in range(2):
        bulk_sink.start(actions, operations._Choosy(), 500, path, checkpoint).awaitTermination()
    return bulk_sink.report(spark, path).agg(*(F.sum(c).alias(c) for c in ("docs", "ok", "failed")))


def _message_files(spark: SparkSession, sf: str, folder: str, name: str = "events") -> None:
    table(spark, sf, name).write.mode("append").parquet(folder)


def _heartbeat(spark: SparkSession, sf: str, folder: str) -> None:
    """One event without a value, two days after all others: it moves the watermark, so all windows before it close."""
    events = table(spark, sf, "events")
    late = events.agg((F.max("ts") + F.expr("interval 2 days")).alias("ts"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "ts" else F.col("ts").cast(f.dataType).alias("ts") for f in events.schema.fields]
    late.select(*empty).filter("ts is not null").write.mode("append").parquet(folder)


def _closed_windows(spark: SparkSession, sf: str, windows) -> DataFrame:
    """Windows of the event stream that are closed after a first start over the events and a second one over a heartbeat."""
    root, folder = work_path(spark, "stream-windows"), work_path(spark, "stream-files")
    schema = table(spark, sf, "events").schema
    for put in (_message_files, _heartbeat):
        put(spark, sf, folder)
        found = windows(file_stream(spark, folder, "parquet", schema).withColumn("ts", F.col("ts").cast("timestamp")))
        state.start_batches(found, f"{root}/out", jobs.checkpoint_path(root, "windows")).awaitTermination()
    return state.read_batches(spark, f"{root}/out", found.schema)


def latency_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly latency windows of a stream, each written once, when it is closed."""
    done = _closed_windows(spark, sf, lambda messages: jobs.latency_windows(messages, "ts", "value", "1 hour", "1 day"))
    return done.select(
        F.unix_millis("start").alias("start_ms"), "messages", F.round("mean", 6).alias("mean"), "min", "max", "median"
    )


def merged_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly sketches of a stream merged to days: exact counts and extremes, and percentiles whose rank among the day's values is within the sketch's error."""
    hours = _closed_windows(spark, sf, lambda messages: jobs.latency_sketches(messages, "ts", "value", "1 hour", "1 day"))
    days = stored(metrics.sketch_figures(metrics.merged_windows(hours, "1 day"), (50, 95, 99)), "days")
    values = table(spark, sf, "events").select(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"), "value")
    met = values.join(days, F.col("day") == F.col("start"))
    ranks = met.groupBy("day").agg(*(F.count_if(F.col("value") < F.col(p)).alias(f"{p}_below") for p in ("p50", "p95", "p99")),
                                   *(F.count_if(F.col("value") <= F.col(p)).alias(f"{p}_to") for p in ("p50", "p95", "p99")))
    n = F.col("messages")
    within = [
        ((F.col(f"{p}_below") <= n * (share + metrics.SKETCH_ERROR) + 1) & (F.col(f"{p}_to") >= n * (share - metrics.SKETCH_ERROR) - 1)).alias(f"{p}_within")
        for p, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    ]
    return days.join(ranks, F.col("start") == F.col("day")).select(F.unix_millis("start").alias("day_ms"), "messages", "min", "max", F.round("mean", 6).alias("mean"), *within)


def live_counts(spark: SparkSession, sf: str, files: int = 10) -> DataFrame:
    """Users and sums per event type over the live rows of a change stream, in ten batches in no order, over two starts."""
    root, folder = work_path(spark, "stream-live"), work_path(spark, "stream-files")
    events = table(spark, sf, "events")
    # A batch of a large table comes in several files, which several tasks read.
    each = part_count(events, 1, files * 4 * 1024 * 1024)
    for half in range(2):
        mine = events.filter(F.pmod(F.hash("event_id"), F.lit(2)) == half)
        mine.repartition(files // 2 * each, "event_id").write.mode("append").parquet(folder)
        raw = cd.change_events(file_stream(spark, folder, "parquet", events.schema, max_files=each))
        routed = cdc.route(cdc.parse_envelope(raw), "C").select("ts_ms", "action", cdc.payload().alias("d"))
        changes = cdc.decode(routed, "d", cd._PAYLOAD).withColumn("value", F.col("value").cast("decimal(20,6)"))
        state.start_live_counts(
            changes, ["user_id"], ["ts_ms", "event_id"], ["event_type"], f"{root}/counts", jobs.checkpoint_path(root, "live"), ["value"]
        ).awaitTermination()
    return state.live_counts(spark, f"{root}/counts").select("event_type", F.col("rows").alias("users"), F.round(F.col("value").cast("double"), 2).alias("value"))


def stitched_events(spark: SparkSession, sf: str) -> DataFrame:
    """The split run events of `lineage_log_events` as a stream: two files of mixed messages, and a last message that lets all heads settle."""
    root, folder = work_path(spark, "stream-stitch"), work_path(spark, "stream-files")
    logs = stored(lineage_queries._logs(spark, sf), "logs")
    beat = logs.agg((F.max("timestamp") + 86_400_000).alias("timestamp")).filter("timestamp is not null")
    beat = beat.select(F.lit("heartbeat").alias("stream"), F.lit("z").alias("event_id"), "timestamp", F.lit("alive").alias("message"))
    for rows in (logs.repartition(2, "event_id"), beat):
        rows.write.mode("append").parquet(folder)
        found = state.stitched_events(file_stream(spark, folder, "parquet", logs.schema), late="1 hour")
        state.start_batches(found, f"{root}/events", jobs.checkpoint_path(root, "stitch")).awaitTermination()
    events = state.read_batches(spark, f"{root}/events", found.schema)
    complete = F.col("complete")
    return events.select(
        "stream",
        F.when(complete, "complete").otherwise("incomplete").alias("state"),
        F.when(complete, F.get_json_object("event", "$.run")).otherwise(F.regexp_extract("event", r'"run":"(\d+)"', 1)).alias("run"),
        F.when(complete, F.get_json_object("event", "$.type")).alias("type"),
        F.when(complete, F.get_json_object("event", "$.n.k")).cast("bigint").alias("k"),
    )


def retried(spark: SparkSession, sf: str) -> DataFrame:
    """A stream whose handler fails on each event type's first batch and is started again, and one that fails twice in a row and stops."""
    root, folder, failed = work_path(spark, "stream-retry"), work_path(spark, "stream-files"), set()
    _message_files(spark, sf, folder)
    stream = file_stream(spark, folder, "parquet", table(spark, sf, "events").schema)

    def fails_once(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in failed:
            failed.add(batch_id)
            raise ValueError("not yet")
        batch.groupBy("event_type").count().write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    def fails(batch: DataFrame, batch_id: int) -> None:
        failed.add(("twice", len(failed)))
        raise ValueError("never")

    starts = jobs.keep_running(lambda: jobs.start(stream, fails_once, jobs.checkpoint_path(root, "once")))
    try:
        jobs.keep_running(lambda: jobs.start(stream, fails, jobs.checkpoint_path(root, "twice")))
    except StreamingQueryException:
        stopped_after = sum(isinstance(f, tuple) for f in failed)
    counts = spark.read.schema("event_type string, count bigint").parquet(f"{root}/out")
    return counts.groupBy("event_type").agg(F.sum("count").alias("events")).withColumns({"starts": F.lit(starts), "tries": F.lit(stopped_after)})


class _Shown(logging.Handler):
    """Keeps (label, rows) of what the display job logs."""

    def __init__(self):
        super().__init__(logging.INFO)
        self.batches: list[tuple[str, list[dict]]] = []

    def emit(self, record: logging.LogRecord) -> None:
        if isinstance(record.args, tuple) and len(record.args) == 2:
            self.batches.append(record.args)


def display(spark: SparkSession, sf: str) -> DataFrame:
    """What the display job logs of a change stream in two batches: twenty message texts each, and the twenty parsed events with the least ids."""
    root, folder = work_path(spark, "stream-display"), work_path(spark, "stream-files")
    schema = table(spark, sf, "events").schema

    def parsed(batch: DataFrame) -> DataFrame:
        row = F.from_json(F.coalesce("after", "before"), cd._PAYLOAD).alias("row")
        return cdc.parse_envelope(batch).select(row).select("row.*").orderBy("event_id")

    shown, level = _Shown(), sinks.log.level
    sinks.log.addHandler(shown)
    sinks.log.setLevel(logging.INFO)
    try:
        for half in range(2):
            table(spark, sf, "events").filter(F.col("event_id") % 2 == half).write.mode("append").parquet(folder)
            raw = cd.change_events(file_stream(spark, folder, "parquet", schema))
            jobs.start_display(raw, jobs.checkpoint_path(root, "display"), views={"texts": lambda batch: batch, "events": parsed}).awaitTermination()
    finally:
        sinks.log.removeHandler(shown)
        sinks.log.setLevel(level)
    batches = {label: rows for label, rows in shown.batches if label.startswith("batch ")}
    out = [
        (int(label.split()[1]), place, row["event_id"], row["user_id"], row["event_type"], len(batches[label.replace("events", "texts")]))
        for label, rows in batches.items()
        if label.endswith(" events")
        for place, row in enumerate(rows, 1)
    ]
    return spark.createDataFrame(out, "batch bigint, place bigint, event_id bigint, user_id bigint, event_type string, texts bigint")


QUERIES = {
    "stream_display": display,
    "stream_cdc_tables": cdc_tables,
    "stream_merge_on_read": merge_on_read,
    "stream_document_load": document_load,
    "stream_document_sink": document_sink,
    "stream_latency_windows": latency_windows,
    "stream_merged_windows": merged_windows,
    "stream_live_counts": live_counts,
    "stream_stitched_events": stitched_events,
    "stream_bounded_retry": retried,
}

ORACLE = {
    "stream_display": """select event_id % 2 as batch, place, event_id, user_id, event_type, least(n, 20) as texts from (
        select *, row_number() over (partition by event_id % 2 order by event_id) as place, count(*) over (partition by event_id % 2) as n from events)
        where place <= 20""",
    "stream_cdc_tables": cd.ORACLE["cdc_demux"],
    "stream_merge_on_read": cd.LIVE_SQL,
    "stream_document_load": documents.ORACLE["docs_write_stats"],
    "stream_document_sink": documents.ORACLE["docs_write_stats"],
    "stream_latency_windows": """select epoch_ms(date_trunc('hour', ts)) as start_ms, count(*) as messages, round(avg(value), 6) as mean,
        min(value) as min, max(value) as max, quantile_disc(value, 0.5) as median from events group by 1""",
    "stream_merged_windows": """select epoch_ms(date_trunc('day', ts)) as day_ms, count(value) as messages, min(value) as min, max(value) as max,
        round(avg(value), 6) as mean, true as p50_within, true as p95_within, true as p99_within from events group by 1""",
    "stream_live_counts": cd.ORACLE["cdc_live_by_type"],
    "stream_stitched_events": lineage_queries.ORACLE["lineage_log_events"],
    "stream_bounded_retry": "select event_type, count(*) as events, 2 as starts, 2 as tries from events group by 1",
}
