"""Day-to-day operations over the given tables: change files, overwrites, batches of a stream, timings and catalog reports."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.jsonx import infer_schema
from lakeops.functions.text import hash_embedder
from lakeops.operators import bulk_sink, cdc, docs, lineage, metrics, sinks, tables, vectors
from lakeops.plans import script
from lakeops.session import part_count, spread, stored, table, work_path
from lakeops.sources import readers
from lakeops.sources.json_array import json_array
from lakeops.streaming import jobs
from lakeops.workloads import change_data as cd
from lakeops.workloads import documents
from lakeops.workloads import lineage as lineage_queries
from lakeops.workloads import retrieval

# --- sources ----------------------------------------------------------------------------------------------


def change_files(spark: SparkSession, sf: str) -> DataFrame:
    """Raw change events, one a line, in folders two levels deep."""
    path = work_path(spark, "changes")
    events = table(spark, sf, "events")
    lines = cd.change_events(events).withColumn("part", F.pmod(F.hash("value"), F.lit(3)).cast("int"))
    lines.withColumn("of", F.pmod(F.hash("value"), F.lit(2)).cast("int")).write.partitionBy("part", "of").text(path)
    parsed = cdc.with_source(cdc.route(cdc.parse_envelope(readers.change_files(spark, path)), "A"))
    return cdc.batch_counts(parsed)


def text_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "text")
    table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    return readers.text_lines(spark, path).groupBy(F.left("value", F.lit(1)).alias("first")).agg(
        F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars")
    )


def json_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer segment is a file that holds one object over several lines."""
    path = work_path(spark, "objects")
    per = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.max("c_custkey").alias("last"))
    text = F.replace(F.to_json(F.struct("c_mktsegment", "customers", "last")), F.lit(","), F.lit(",\n"))
    per.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return readers.json_documents(spark, path).select(F.col("c_mktsegment").alias("segment"), "customers", "last")


def _array_files(rows: DataFrame, path: str, files: int) -> None:
    """Each task's rows of JSON text as one array over a single file, an element a line."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "[ "
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                out.append(mark + text)
                mark = " , "
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if mark != "[ " else "[]"])], names=["value"])

    rows.repartition(files, *rows.columns).mapInArrow(lines, "value string").write.text(path)


def json_array_blocks(spark: SparkSession, sf: str, block_bytes: int = 64 * 1024) -> DataFrame:
    """Large arrays read in small blocks; texts and notes hold brackets, commas, quotes and backslashes."""
    path = work_path(spark, "arrays")
    note = F.concat(F.lit('],[{"}\\'), F.col("source"), F.lit('"\\\\,{ '))
    inner = F.array(F.struct(F.col("n_chars").alias("n"), note.alias("note")))
    _array_files(table(spark, sf, "documents").select(F.to_json(F.struct("doc_id", "text", inner.alias("parts"), note.alias("note"))).alias("value")), path, part_count(table(spark, sf, "documents"), 3))
    rows = json_array(spark, path, block_bytes=block_bytes)
    return rows.select("doc_id", F.md5("text").alias("digest"), "note", F.get("parts", F.lit(0))["n"].alias("n"), F.get("parts", F.lit(0))["note"].alias("inner_note"))


def inline_rows(spark: SparkSession, sf: str) -> DataFrame:
    names = readers.inline_rows(spark, [("R", "returned"), ("A", "accepted"), ("N", "none")], "flag string, meaning string")
    lines = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("lines"))
    return lines.join(names, F.col("l_returnflag") == F.col("flag"), "left").select("l_returnflag", "meaning", "lines")


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """As many trips as there are orders, joined with them by number."""
    orders = table(spark, sf, "orders")
    first, n = orders.agg(F.min("o_orderkey"), F.max("o_orderkey") - F.min("o_orderkey") + 1).head()
    made = readers.synthetic_trips(spark, first or 0, n or 0)
    return made.join(orders, F.col("trip_id") == F.col("o_orderkey")).groupBy("route_id", "destination").agg(F.count("*").alias("orders"))


# --- tables -----------------------------------------------------------------------------------------------


def overwritten(spark: SparkSession, sf: str) -> DataFrame:
    """A table that already has rows is emptied and filled anew, by SQL and by the writer."""
    run, path = uuid.uuid4().hex[:10], work_path(spark, "overwrite")
    customers = table(spark, sf, "customer")
    customers.createOrReplaceTempView(f"customers_{run}")
    spark.sql(f"create database lake_{run} location '{path}/database'")
    customers.select("c_custkey", "c_mktsegment").write.saveAsTable(f"lake_{run}.segments")
    spark.sql(f"truncate table lake_{run}.segments")
    spark.sql(f"insert into lake_{run}.segments select c_custkey, c_mktsegment from customers_{run} where c_acctbal > 0")
    by_sql = spark.table(f"lake_{run}.segments").withColumn("way", F.lit("sql"))
    lake = tables.BucketTable(spark, f"{path}/lake", ["c_custkey"])
    lake.overwrite(customers.select("c_custkey", "c_mktsegment"))
    lake.overwrite(customers.filter("c_acctbal <= 0").select("c_custkey", "c_mktsegment"))
    both = by_sql.unionByName(lake.snapshot().withColumn("way", F.lit("writer")))
    report = both.groupBy("way", "c_mktsegment").agg(F.count("*").alias("customers"), F.sum("c_custkey").alias("keys"))
    report.write.parquet(f"{path}/report")
    spark.sql(f"drop database lake_{run} cascade")
    return spark.read.schema(report.schema).parquet(f"{path}/report")


def file_days(spark: SparkSession, sf: str, file_bytes: int = 128 * 1024) -> DataFrame:
    """Events by day, written in many small files by eight tasks and rewritten in files of bounded bytes: rows, and whether size and number are as asked."""
    small, path = work_path(spark, "small"), work_path(spark, "sizes")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    events.repartition(8).write.partitionBy("day").parquet(small)
    tables.compact_files(spark, small, path, ["day"], file_bytes)
    day = F.regexp_extract("path", r"day=([^/]+)", 1).alias("day")
    files = tables.file_sizes(spark, path).groupBy(day).agg(F.count("*").alias("files"), F.min("bytes").alias("least"), F.max("bytes").alias("most"), F.sum("bytes").alias("all"))
    before = tables.file_sizes(spark, small).groupBy(day.alias("was")).agg(F.count("*").alias("small"))
    rows = spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("of")).agg(F.count("*").alias("events"))
    met = files.join(before, F.col("day") == F.col("was")).join(rows, F.col("day") == F.col("of"))
    # A file may be a little longer than the rows a file say, as rows differ.
    within = (F.col("most") <= 1.5 * file_bytes) & (F.col("files") <= F.ceil(F.col("all") / file_bytes) + 1)
    return met.select("day", "events", (F.col("least") > 0).cast("int").alias("filled"), within.alias("within"), (F.col("files") <= F.col("small")).alias("no_more_files"))


def semistructured(spark: SparkSession, sf: str) -> DataFrame:
    rows = sinks.mark_semistructured(table(spark, sf, "events").select("event_id", "event_type", "props"), ["props", "absent"])
    marks = {f.name: f.metadata.get("redshift_type") for f in rows.schema.fields}
    counts = rows.agg(*(F.count(c).alias(c) for c in rows.columns)).unpivot([], rows.columns, "field", "filled")
    known = reduce(lambda c, n: c.when(F.col("field") == n, F.lit(marks[n])), marks, F.when(F.lit(False), F.lit("")))
    return counts.withColumn("kind", known)


# --- documents --------------------------------------------------------------------------------------------


def write_batches(spark: SparkSession, sf: str, size: int = 100) -> DataFrame:
    """Batches of up to `size`: all full but the last of each task; a batch with a French document fails whole."""
    parts = part_count(table(spark, sf, "documents"), 4)
    # The documents of one index stay together as long as a task can hold them.
    salt = F.pmod(F.xxhash64("_id"), F.lit(parts if parts > 4 else 1))
    actions = documents.actions(spark, sf).repartition(parts, "_index", salt)
    stats = docs.bulk_write(actions, documents._Picky(), size, work_path(spark, "report"))
    small = F.count_if(F.col("docs") < size)
    return stats.agg(
        F.sum("docs").alias("docs"), F.sum(F.col("ok") + F.col("failed")).alias("answered"), (F.max("docs") <= size).alias("within"),
        (small <= F.count_distinct("partition")).alias("only_last_small"), F.count_if((F.col("failed") > 0) & (F.col("failed") != F.col("docs"))).alias("half_failed"),
    )


def dead_letter_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Only French documents, in batches of a thousand: all of them come back as dead letters."""
    letters = work_path(spark, "letters")
    actions = documents.actions(spark, sf).filter("_index = 'docs-fr-v1'")
    docs.bulk_write(actions, documents._Picky(), 1000, work_path(spark, "report"), letters)
    shape = "error string, timestamp string, index string, data array<struct<_id: string, text: string>>"
    back = spark.read.schema(shape).json(letters)
    return back.select("error", "index", F.explode("data").alias("d")).select("error", "index", F.col("d._id").alias("id"), F.md5("d.text").alias("digest"))


class _Choosy:
    """A writer that takes a batch but for its French documents."""

    def __call__(self):
        def write(batch: list[dict]) -> tuple[int, int]:
            french = {a["_id"]: "fr not accepted" for a in batch if a["_index"] == "docs-fr-v1"}
            if french:
                raise bulk_sink.Refused(french)
            return len(batch), 0

        return write


def sink_report(spark: SparkSession, sf: str, size: int = 500) -> DataFrame:
    """A load of all documents, one of the French ones, and the first again: each name counts once."""
    path, actions = work_path(spark, "bulk"), documents.actions(spark, sf)
    for name in ("all", "french", "all"):
        bulk_sink.load(actions if name == "all" else actions.filter("_index = 'docs-fr-v1'"), _Choosy(), size, path, name)
    return bulk_sink.report(spark, path).groupBy("load").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", "ok", "failed", "refused")),
        (F.sum("batches") <= F.sum(F.ceil(F.col("docs") / size))).alias("full_batches"),
    )


def sink_letters(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that a load refused one by one, with their texts."""
    path = work_path(spark, "bulk")
    bulk_sink.load(documents.actions(spark, sf), _Choosy(), 500, path, "all")
    back = bulk_sink.letters(spark, path)
    return back.select("error", "index", "id", F.md5(F.from_json("source", "text string")["text"]).alias("digest"))


def resumed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in batches of up to a thousand, in two loads; a batch with a French document fails whole, and is answered all the same."""
    rows = documents.actions(spark, sf).withColumn("doc_id", F.col("_id").cast("bigint"))
    state, report = work_path(spark, "state"), work_path(spark, "resume")
    step = rows.count() // 3 + 1
    docs.resumable_load(rows.filter("doc_id < 100"), "doc_id", documents._Picky(), 1000, state, report, step)
    last = docs.load_state(spark, state)
    docs.save_state(spark, state, last["position"], last["processed_docs"], False)  # more rows have come
    stats = docs.resumable_load(rows, "doc_id", documents._Picky(), 1000, state, report, step)
    done = docs.load_state(spark, state)
    return stats.agg(F.sum(F.col("ok") + F.col("failed")).alias("answered"), (F.max("docs") <= 1000).alias("within")).withColumns(
        {"position": F.lit(done["position"]).cast("bigint"), "processed": F.lit(done["processed_docs"]).cast("bigint")}
    )


def prepared_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The first thousand non-blank documents by id, spread over eight tasks and embedded."""
    some = vectors.prepare_texts(table(spark, sf, "documents").select("doc_id", "text"), "text", pieces=8, limit=1000, order=["doc_id"])
    embedded = vectors.embed(some, "text", hash_embedder)
    return embedded.select("doc_id", F.length("text").cast("bigint").alias("chars"), F.size("embedding").cast("bigint").alias("width"))


def trained_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Search in cells trained by k-means, with the mean vector of each label as queries: recall against exact search."""
    corpus, queries = retrieval._embeddings(spark, sf), retrieval._labels(spark, sf)
    cells = vectors.train_cells(corpus, 16)
    found = vectors.cell_knn(queries, corpus, cells, 10, probes=12)
    recall = vectors.recall_at_k(vectors.knn(queries, corpus, 10), found, 10)
    return recall.agg(F.count("*").alias("queries"), (F.avg("recall") >= 0.9).alias("good"))


def coded_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Search on product-quantised codes of 16 bytes a vector, for every twentieth vector: recall against exact search, and bytes against the vectors'."""
    corpus = retrieval._embeddings(spark, sf)
    queries = corpus.filter("doc_id % 20 = 0")
    books = vectors.train_codebooks(corpus, 16, 256)
    coded = stored(vectors.encode(corpus, books), "codes")
    found = vectors.coded_knn(queries, coded, corpus, books, 10, query_id="doc_id", exclude_self=True)
    recall = vectors.recall_at_k(vectors.knn(queries, corpus, 10, query_id="doc_id", exclude_self=True), found, 10)
    share = coded.agg(F.sum(F.length("code"))).head()[0] / (corpus.agg(F.sum(F.size("embedding"))).head()[0] * 4)
    return recall.agg(F.count("*").alias("queries"), (F.avg("recall") >= 0.9).alias("good")).withColumn("a_third_of_the_bytes", F.lit(share < 1 / 3))


# --- change data ------------------------------------------------------------------------------------------


def ingest_time(spark: SparkSession, sf: str) -> DataFrame:
    started = F.lit(time.time()).cast("timestamp")
    stamped = cdc.with_ingest_time(table(spark, sf, "events").select("event_id", "event_type"), "seen")
    return stamped.groupBy("event_type").agg(F.count("*").alias("events"), F.count_if(F.col("seen") >= started).alias("stamped"))


def table_settings(spark: SparkSession, sf: str) -> DataFrame:
    """Settings of one table per region and nation, written as JSON, read as configuration."""
    pairs = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    entries = [
        {"db": r["r_name"].lower(), "table": r["n_name"].lower(), "primary_key": "id, day" if r["n_nationkey"] % 2 else "id", "format-version": r["n_nationkey"]}
        for r in pairs.select("r_name", "n_name", "n_nationkey").collect()
    ]
    path = work_path(spark, "settings") + ".json"
    tables.write_text(spark, path, json.dumps(entries))
    rows = [(c.db, c.table, ",".join(c.primary_key), c.properties["format-version"]) for c in cdc.load_table_config(spark, path)]
    return spark.createDataFrame(rows, "db string, name string, keys string, version string")


def replayed_ddl(spark: SparkSession, sf: str) -> DataFrame:
    """A column for each event type is added to a table by replaying a change log."""
    name = f"ddl_{uuid.uuid4().hex[:10]}"
    spark.sql(f"create table {name} (id bigint) using parquet location '{work_path(spark, 'ddl')}'")
    kinds = table(spark, sf, "events").groupBy("event_type").agg(F.min("event_id").alias("pos"))
    work = kinds.select(F.lit(0).alias("ts_ms"), "pos", F.concat(F.lit(f"alter table {name} add columns ("), "event_type", F.lit(" double)")).alias("ddl"))
    cdc.replay_ddl(spark, work.unionByName(work))
    rows = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
    spark.sql(f"drop table {name}")
    return spark.createDataFrame(rows, "field string, kind string")


def null_batch_types(spark: SparkSession, sf: str) -> DataFrame:
    """A first batch fixes the types, a second one holds nothing but nulls in two columns: the types stay."""
    lake = tables.BucketTable(spark, work_path(spark, "nulls"), ["event_id"])
    events = spread(table(spark, sf, "events"))
    config = cdc.TableConfig("shop", "log", ("event_id",))
    for batch, gone in enumerate((False, True)):
        value, n = (F.lit(None) if gone else F.col(c) for c in ("value", "user_id"))
        row = F.struct(F.col("event_id"), value.alias("amount"), n.alias("n"))
        source = F.struct(F.lit("shop").alias("db"), F.lit("log").alias("table"))
        wanted = events.filter(F.col("event_id") % 2 == batch)
        raw = wanted.select(F.to_json(F.struct(row.alias("after"), source.alias("source"), F.lit("c").alias("op"), cd.ts_ms().alias("ts_ms")), {"ignoreNullFields": "false"}).alias("value"))
        jobs.apply_batch(raw, batch, [config], {("shop", "log"): lake})
    kinds = {f.name: f.dataType.simpleString() for f in lake.schema.fields}
    return lake.snapshot().agg(
        F.count("*").alias("rows"), F.count("amount").alias("amounts"), F.round(F.sum("amount"), 2).alias("amount"), F.sum("n").alias("n")
    ).withColumns({"amount_type": F.lit(kinds["amount"]), "n_type": F.lit(kinds["n"])})


def big_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers of 20 digits come through JSON unharmed, by a found schema."""
    big = F.concat(F.lit("12345678901"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    raw = table(spark, sf, "orders").select(F.concat(F.lit('{"id":'), big, F.lit(',"k":'), F.col("o_orderkey").cast("string"), F.lit("}")).alias("d"))
    decoded = cdc.decode(raw, "d", infer_schema(raw, "d"))
    return decoded.select(F.col("id").cast("string").alias("id"), "k")


def unrouted_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of tables nobody configured are handed back, none is lost."""
    parsed = cdc.with_source(cdc.parse_envelope(cd.change_events(table(spark, sf, "events"))))
    return cdc.unrouted(parsed, cd._TABLES[:2]).groupBy("db", "table").agg(F.count("*").alias("events"))


def list_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """A payload that is a list is unreadable: one row with nulls, not several rows."""
    data = F.when(F.col("event_type") == "click", F.to_json(F.array(F.struct("user_id"), F.struct("user_id")))).otherwise(F.to_json(F.struct("user_id")))
    rows = cdc.decode(table(spark, sf, "events").select("event_id", data.alias("d")), "d", "user_id bigint")
    return rows.select("event_id", "user_id")


# --- streams ----------------------------------------------------------------------------------------------


def _event_files(spark: SparkSession, sf: str, path: str, part: int, parts: int) -> None:
    """One file for every fifth of a part of the events, in event order within none."""
    mine = table(spark, sf, "events").filter(F.pmod("event_id", F.lit(parts)) == part)
    mine.repartition(5, "event_id").write.mode("append").parquet(path)


def _states(spark: SparkSession, root: str) -> DataFrame:
    lakes = jobs.open_tables(spark, cd._TABLES, root)
    parts = [
        lake.snapshot().select(F.lit(db).alias("db"), F.lit(name).alias("table"), "user_id", "event_id", "event_type")
        for (db, name), lake in lakes.items()
        if lake.schema is not None
    ]
    return reduce(DataFrame.unionByName, parts)


def _run_stream(spark: SparkSession, sf: str, folder: str, root: str, job: str, interval: str | None = None) -> None:
    schema = table(spark, sf, "events").schema
    stream = cd.change_events(readers.file_stream(spark, folder, "parquet", schema, max_files=2))
    query = jobs.start_cdc(stream, cd._TABLES, root, jobs.checkpoint_path(root, job), interval=interval)
    if interval:
        query.processAllAvailable()
        query.stop()
    query.awaitTermination()


def many_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Changes that come in many micro-batches, in no order, over two starts, one by trigger interval, and one start that finds nothing new."""
    root, folder = work_path(spark, "stream-many"), work_path(spark, "stream-files")
    _event_files(spark, sf, folder, 0, 2)
    _run_stream(spark, sf, folder, root, "cdc")
    _event_files(spark, sf, folder, 1, 2)
    _run_stream(spark, sf, folder, root, "cdc", interval="1 second")
    _run_stream(spark, sf, folder, root, "cdc")
    return _states(spark, root)


def two_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams with checkpoints of their own feed the same tables: neither takes rows from the other."""
    root = work_path(spark, "stream-two")
    for part in range(2):
        folder = work_path(spark, "stream-files")
        _event_files(spark, sf, folder, part, 2)
        _run_stream(spark, sf, folder, root, f"cdc-{part}")
    return _states(spark, root)


def partitioned_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Targets foldered as their configuration says: one row per folder value, told from the files' paths."""
    root, folder, path = work_path(spark, "stream-parts"), work_path(spark, "stream-files"), work_path(spark, "settings") + ".json"
    entries = [
        {"db": t.db, "table": t.table, "primary_key": "user_id", "partition_by": "event_type", "buckets": 4, "schema": t.schema} for t in cd._TABLES
    ]
    tables.write_text(spark, path, json.dumps(entries))
    configs = cdc.load_table_config(spark, path)
    _event_files(spark, sf, folder, 0, 1)
    schema = table(spark, sf, "events").schema
    stream = cd.change_events(readers.file_stream(spark, folder, "parquet", schema, max_files=2))
    jobs.start_cdc(stream, configs, root, jobs.checkpoint_path(root, "parts")).awaitTermination()
    parts = []
    for (db, name), lake in jobs.open_tables(spark, configs, root).items():
        if lake.schema is not None:
            rows = lake._in_folders(lake._stored_schema(), None).filter(~F.col(cdc.DELETED))
            rows = rows.withColumn("event_type", F.regexp_extract("_folder", "/event_type=(.*)", 1))
            parts.append(rows.groupBy("event_type").agg(F.count("*").alias("users"), F.max("user_id").alias("last")).withColumns({"db": F.lit(db), "table": F.lit(name)}))
    return reduce(DataFrame.unionByName, parts)


# --- lineage, metrics, scripts ----------------------------------------------------------------------------


def log_since(spark: SparkSession, sf: str) -> DataFrame:
    """A second search starts behind the last event of the first, which saw the first half of the time."""
    logs = lineage_queries._logs(spark, sf)
    low, high = logs.agg(F.min("timestamp"), F.max("timestamp")).head()
    first = logs.filter(F.col("timestamp") <= (low + high) // 2)
    position = lineage.next_position(first, low)
    return lineage.since(logs, position).groupBy("stream").agg(F.count("*").alias("events"), F.min("timestamp").alias("first"))


def task_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events in workflow-task logs, which mark them otherwise than job logs."""
    message = F.concat(
        F.lit(f"[2024] {lineage.TASK_MARKER}"), F.to_json(F.struct(F.col("event_id").alias("run"), F.col("event_type").alias("type"))), F.lit("\n[2024] done")
    )
    logs = table(spark, sf, "events").select(
        F.concat(F.lit("task-"), (F.col("user_id") % 16).cast("string")).alias("stream"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"),
        cd.ts_ms().alias("timestamp"),
        F.when(F.col("event_type") == "view", "no event").otherwise(message).alias("message"),
    )
    complete, _ = lineage.extract_log_events(logs, lineage.TASK_MARKER)
    return complete.select(
        "stream", F.get_json_object("event", "$.run").cast("bigint").alias("run"), F.get_json_object("event", "$.type").alias("type")
    )


def write_throughput(spark: SparkSession, sf: str) -> DataFrame:
    stats = docs.bulk_write(documents.actions(spark, sf), documents._Picky(), 1, work_path(spark, "report"))
    total = metrics.write_throughput(stats)
    per = metrics.batch_throughput(stats).agg(F.count_if((F.col("ok") > 0) & (F.col("docs_per_s") > 0)).alias("timed"))
    fast = (F.col("docs_per_s") > 0) & (F.col("mean_worker_seconds") > 0)
    return total.select("docs", "ok", "failed", fast.cast("int").alias("measured")).join(per.select("timed"), F.lit(True))


def timed_writes(spark: SparkSession, sf: str) -> DataFrame:
    rows = []
    for name in ("orders", "lineitem"):
        path = work_path(spark, f"timed-{name}")
        timed = metrics.timed_write(spark, name, lambda n=name, p=path: table(spark, sf, n).write.parquet(p))
        rows.append(timed.withColumn("rows", F.lit(spark.read.parquet(path).count())))
    both = reduce(DataFrame.unionByName, rows)
    return both.select(F.col("tablename").alias("name"), (F.col("executiontime") > 0).alias("timed"), F.col("rows").alias("written"))


def shown_results(spark: SparkSession, sf: str) -> DataFrame:
    """A script run in a database of its own; each statement's result is seen as it comes."""
    run, seen = uuid.uuid4().hex[:10], []
    spark.sql(f"create database lake_{run} location '{work_path(spark, 'database')}'")
    before = spark.catalog.currentDatabase()
    table(spark, sf, "nation").createOrReplaceTempView(f"nation_{run}")
    text = f"create table by_region as select n_regionkey as region, count(*) as n from nation_{run} group by 1; select * from by_region; select sum(n) as n from by_region"
    try:
        script.run_script(spark, text, database=f"lake_{run}", on_result=lambda i, df: seen.append((i, len(df.columns), [r[-1] for r in df.collect()])))
        listed = script.list_tables(spark, f"lake_{run}").filter("not temporary").collect()
        databases = script.list_databases(spark).filter(F.col("database") == f"lake_{run}").count()
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"drop database lake_{run} cascade")
    rows = [(i, columns, sum(values)) for i, columns, values in seen] + [(100, len(listed), databases)]
    return spark.createDataFrame(rows, "step int, width int, total bigint")


QUERIES = {
    "source_change_files": change_files,
    "source_text_lines": text_lines,
    "source_json_objects": json_objects,
    "source_json_array_blocks": json_array_blocks,
    "source_inline_rows": inline_rows,
    "source_synthetic_trips": trips,
    "lake_overwrite_existing": overwritten,
    "lake_file_days": file_days,
    "sink_semistructured": semistructured,
    "docs_write_batches": write_batches,
    "docs_dead_letter_batches": dead_letter_batches,
    "docs_sink_report": sink_report,
    "docs_sink_letters": sink_letters,
    "docs_resume_batches": resumed_batches,
    "embed_prepared": prepared_texts,
    "recall_trained_cells": trained_recall,
    "recall_product_codes": coded_recall,
    "cdc_ingest_time": ingest_time,
    "cdc_table_config": table_settings,
    "cdc_replay_ddl": replayed_ddl,
    "cdc_null_batch_types": null_batch_types,
    "cdc_big_numbers": big_numbers,
    "cdc_unrouted": unrouted_events,
    "cdc_list_payloads": list_payloads,
    "stream_cdc_many_batches": many_batches,
    "stream_cdc_two_writers": two_writers,
    "stream_cdc_partitioned": partitioned_targets,
    "lineage_log_since": log_since,
    "lineage_task_events": task_events,
    "metrics_write_throughput": write_throughput,
    "metrics_timed_writes": timed_writes,
    "script_shown_results": shown_results,
}

_ALIVE = cd.ORACLE["cdc_demux"]
_HALF_SQL = """l as (select 'job-' || (event_id % 256) as stream, epoch_us(ts) // 1000 + unnest(case event_id % 5 when 0 then [0, 10, 20] when 1 then [0, 500]
    when 2 then [0, 5, 9] else [0] end) as t from events)"""

ORACLE = {
    "source_change_files": cd.ORACLE["cdc_table_action_counts"],
    "source_text_lines": """select left(line, 1) as first, count(*) as lines, cast(sum(length(line)) as bigint) as chars
      from (select unnest(string_split(text, chr(10))) as line from documents) group by 1""",
    "source_json_objects": "select c_mktsegment as segment, count(*) as customers, max(c_custkey) as last from customer group by 1",
    "source_json_array_blocks": """with n as (select *, '],[{"}\\' || source || '"\\\\,{ ' as note from documents)
      select doc_id, md5(text) as digest, note, n_chars as n, note as inner_note from n""",
    "source_inline_rows": """select l_returnflag, case l_returnflag when 'R' then 'returned' when 'A' then 'accepted' when 'N' then 'none' end as meaning,
      count(*) as lines from lineitem group by 1""",
    "source_synthetic_trips": f"""select chr(65 + cast(o_orderkey % 10 as integer)) as route_id,
      ({readers.DESTINATIONS!r})[o_orderkey % 10 + 1] as destination, count(*) as orders from orders group by 1, 2""",
    "lake_overwrite_existing": """select case when c_acctbal > 0 then 'sql' else 'writer' end as way, c_mktsegment, count(*) as customers,
      cast(sum(c_custkey) as bigint) as keys from customer group by 1, 2""",
    "lake_file_days": "select cast(cast(ts as date) as varchar) as day, count(*) as events, 1 as filled, true as within, true as no_more_files from events group by 1",
    "sink_semistructured": """select 'event_id' as field, count(event_id) as filled, null as kind from events
      union all select 'event_type', count(event_type), null from events union all select 'props', count(props), 'super' from events""",
    "docs_write_batches": "select count(*) as docs, count(*) as answered, true as within, true as only_last_small, 0 as half_failed from documents",
    "docs_dead_letter_batches": """select 'fr not accepted' as error, 'docs-fr-v1' as index, cast(doc_id as varchar) as id, md5(text) as digest
      from documents where lang = 'fr'""",
    "docs_sink_report": """select load, count(*) as docs, count(*) filter (where lang is distinct from 'fr') as ok, count(*) filter (where lang = 'fr') as failed,
      count(*) filter (where lang = 'fr') as refused, true as full_batches
      from documents join (values ('all'), ('french')) l(load) on load = 'all' or lang = 'fr' group by 1""",
    "docs_sink_letters": """select 'fr not accepted' as error, 'docs-fr-v1' as index, cast(doc_id as varchar) as id, md5(text) as digest
      from documents where lang = 'fr'""",
    "docs_resume_batches": "select count(*) as answered, true as within, max(doc_id) as position, count(*) as processed from documents",
    "embed_prepared": """select doc_id, length(text) as chars, 64 as width from documents where length(trim(text)) > 0 order by doc_id limit 1000""",
    "recall_product_codes": "select count(*) as queries, true as good, true as a_third_of_the_bytes from embeddings where vec_id % 20 = 0",
    "recall_trained_cells": "select count(distinct label) as queries, true as good from embeddings",
    "cdc_ingest_time": "select event_type, count(*) as events, count(*) as stamped from events group by 1",
    "cdc_table_config": """select lower(r_name) as db, lower(n_name) as name, case when n_nationkey % 2 = 1 then 'id,day' else 'id' end as keys,
      cast(n_nationkey as varchar) as version from nation, region where n_regionkey = r_regionkey""",
    "cdc_replay_ddl": "select distinct event_type as field, 'double' as kind from events union all select 'id', 'bigint'",
    "cdc_null_batch_types": """select count(*) as "rows", count(*) filter (where event_id % 2 = 0) as amounts,
      round(sum(value) filter (where event_id % 2 = 0), 2) as amount, cast(sum(user_id) filter (where event_id % 2 = 0) as bigint) as n,
      'double' as amount_type, 'bigint' as n_type from events""",
    "cdc_big_numbers": "select '12345678901' || lpad(cast(o_orderkey as varchar), 9, '0') as id, o_orderkey as k from orders",
    "cdc_unrouted": """select 'shop' as db, case when event_type in ('view', 'click') then 'visits' else 'users' end as "table", count(*) as events
      from events where user_id % 2 = 0 group by 2""",
    "cdc_list_payloads": "select event_id, case when event_type <> 'click' then user_id end as user_id from events",
    "stream_cdc_many_batches": _ALIVE,
    "stream_cdc_two_writers": _ALIVE,
    "stream_cdc_partitioned": f"""select db, "table", event_type, count(*) as users, max(user_id) as last from ({_ALIVE}) group by 1, 2, 3""",
    "lineage_log_since": f"""with {_HALF_SQL}, half as (select (min(t) + max(t)) // 2 as m from l), p as (select max(t) + 1 as begin_ms from l, half where t <= m)
      select stream, count(*) as events, min(t) as first from l, p where t >= begin_ms group by 1""",
    "lineage_task_events": "select 'task-' || (user_id % 16) as stream, event_id as run, event_type as type from events where event_type <> 'view'",
    "metrics_write_throughput": """select count(*) as docs, count(*) filter (where lang <> 'fr') as ok, count(*) filter (where lang = 'fr') as failed,
      1 as measured, count(*) filter (where lang <> 'fr') as timed from documents""",
    "metrics_timed_writes": "select 'orders' as name, true as timed, count(*) as written from orders union all select 'lineitem', true, count(*) from lineitem",
    "script_shown_results": """with r as (select n_regionkey, count(*) as n from nation group by 1)
      select 1 as step, 0 as width, 0 as total union all select 2, 2, cast(sum(n) as bigint) from r union all select 3, 1, cast(sum(n) as bigint) from r
      union all select 100, 1, 1""",
}
