"""Lineage: query history to run events, column and table edges, events out of job logs, crawl matching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import parent_path, unescape
from lakeops.operators.ordered import CHUNK, running_max, with_chunk
from lakeops.session import stored

# Query kinds that move data, texts that mark events in job logs, and the identifiers of the events.
QUERY_TYPES = ("DDL", "CTAS", "COPY", "INSERT", "UNLOAD")
SPARK_MARKER = "INFO [spark-listener-group-shared] transports.ConsoleTransport "
TASK_MARKER = "{console.py:30} INFO - "
JOB_PREFIX = "redshift-query-"
JOB_INTEGRATION = "Redshift"
CRAWL_JOBS = "glue_crawler"
CRAWL_INTEGRATION = "glue"
EVENT_SCHEMA = "https://openlineage.io/spec/2-0-2/OpenLineage.json#/$defs/RunEvent"
QUERY_PRODUCER = "https://github.com/OpenLineage/OpenLineage/blob/v1-0-0/client"
SQL_PRODUCER = "https://github.com/OpenLineage/OpenLineage/tree/0.10.0/integration/sql"
SQL_SCHEMA = "https://raw.githubusercontent.com/OpenLineage/OpenLineage/main/spec/OpenLineage.json#/definitions/SQLJobFacet"
DATASET_SCHEMA = "https://raw.githubusercontent.com/OpenLineage/OpenLineage/main/spec/OpenLineage.json#/definitions/SchemaDatasetFacet"
JOB_TYPE_SCHEMA = "https://openlineage.io/spec/facets/2-0-2/JobTypeJobFacet.json"
COLUMN_PRODUCER = "https://github.com/OpenLineage/OpenLineage/tree/1.4.1/integration/"
COLUMN_SCHEMA = "https://openlineage.io/spec/facets/1-0-1/ColumnLineageDatasetFacet.json"
CRAWL_PRODUCER = "https://github.com/OpenLineage/OpenLineage/tree/1.9.1/integration/glue"
CRAWL_JOB_TYPE_SCHEMA = "https://openlineage.io/spec/facets/2-0-2/JobTypeJobFacet.json#/$defs/JobTypeJobFacet"
CRAWL_DATASET_SCHEMA = "https://openlineage.io/spec/facets/1-0-0/SchemaDatasetFacet.json#/$defs/SchemaDatasetFacet"
CRAWL_COLUMN_SCHEMA = "https://openlineage.io/spec/facets/1-0-0/SchemaDatasetFacet.json#/$defs/ColumnLineageDatasetFacet"
SYMLINK_SCHEMA = "https://openlineage.io/spec/facets/1-0-0/SymlinksDatasetFacet.json#/$defs/SymlinksDatasetFacet"
RUN_SCHEMA = "https://openlineage.io/spec/2-0-2/OpenLineage.json#/$defs/RunFacet"


def _facet(producer: str, schema: str, *content: Column) -> Column:
    return F.struct(F.lit(producer).alias("_producer"), F.lit(schema).alias("_schemaURL"), *content)


# --- query history ----------------------------------------------------------------------------------------


def query_texts(parts: DataFrame, max_parts: int | None = None) -> DataFrame:
    """Whole query texts from numbered parts: (query_id, query_txt). `max_parts` leaves later parts out, as some histories do."""
    kept = parts if max_parts is None else parts.filter(F.col("sequence") < max_parts)
    return kept.groupBy("query_id").agg(
        F.expr("listagg(rtrim(text)) within group (order by sequence, text)").alias("query_txt")
    )


def query_history(
    history: DataFrame,
    parts: DataFrame,
    details: DataFrame,
    tables: DataFrame,
    start_time: str | None = None,
    types: Sequence[str] = QUERY_TYPES,
    unescape_text: bool = False,
) -> DataFrame:
    """Distinct (query, table) rows with the query's whole text.

    `history` has query_id, user_id, transaction_id, session_id, start_time, end_time, query_type; `details` links
    query_id to table_id; `tables` has table_id, database, schema, table, table_type.
    """
    wanted = history.filter(F.col("query_type").isin(*types))
    if start_time is not None:
        wanted = wanted.filter(F.col("start_time") >= F.lit(start_time))
    links = details.select("query_id", "table_id").distinct()
    joined = (
        wanted.join(links, "query_id")  # an unlinked query has no table and would drop out at the next join
        .join(tables, "table_id")
        .select(
            "database", "schema", "table", "table_type", "user_id", "query_id", "transaction_id", "session_id", "start_time", "end_time"
        )
        .distinct()
    )
    texts = query_texts(parts)
    if unescape_text:
        texts = texts.withColumn("query_txt", unescape("query_txt"))
    return joined.join(texts, "query_id", "left")


def _source_name(edges: DataFrame) -> Column:
    return F.concat_ws(
        ".", F.coalesce("source_database", "database"), F.coalesce("source_schema", "schema"), "source_table"
    )


def with_defaults(edges: DataFrame, queries: DataFrame) -> DataFrame:
    """Edges with the query's database and schema, which stand in for missing ones."""
    return edges.join(queries.select("query_id", "database", "schema", "table_type").distinct(), "query_id")


def column_lineage(edges: DataFrame, queries: DataFrame, namespace: str) -> DataFrame:
    """Input fields of each output column: (query_id, target_column, input_fields).

    `edges` has query_id, target_column, source_database, source_schema, source_table, source_column. The list of
    one output column is bounded by the text of its query.
    """
    full = with_defaults(edges, queries)
    field = F.struct(F.lit(namespace).alias("namespace"), _source_name(full).alias("name"), F.col("source_column").alias("field"))
    return full.groupBy("query_id", "target_column").agg(F.array_sort(F.collect_set(field)).alias("input_fields"))


def table_schemas(columns: DataFrame) -> DataFrame:
    """Columns of each table as one ordered list: (database, schema, table, fields)."""
    entry = F.struct("position", F.struct(F.trim("column").alias("name"), F.trim("type").alias("type")).alias("f"))
    listed = columns.groupBy("database", "schema", "table").agg(F.array_sort(F.collect_list(entry)).alias("_f"))
    return listed.select("database", "schema", "table", F.transform("_f", lambda e: e["f"]).alias("fields"))


def dataset_nodes(tables: DataFrame, queries: DataFrame, columns: DataFrame, namespace: str) -> DataFrame:
    """Dataset node of every table a query touches: (query_id, role, name, node).

    `tables` has query_id, role (input or output), database, schema, table; missing names come from the query.
    """
    asked = tables.withColumnsRenamed({"database": "_db", "schema": "_schema"})
    full = asked.join(queries.select("query_id", "database", "schema", "table_type").distinct(), "query_id").select(
        "query_id",
        "role",
        F.coalesce("_db", "database").alias("database"),
        F.coalesce("_schema", "schema").alias("schema"),
        "table",
        "table_type",
    )
    known = full.distinct().join(table_schemas(columns), ["database", "schema", "table"], "left")
    name = F.concat_ws(".", "database", "schema", "table", "table_type")
    node = F.struct(
        F.lit(namespace).alias("namespace"),
        name.alias("name"),
        F.struct(_facet(SQL_PRODUCER, DATASET_SCHEMA, F.coalesce("fields", F.array()).alias("fields")).alias("schema")).alias(
            "facets"
        ),
    )
    return known.select("query_id", "role", name.alias("name"), node.alias("node"))


def run_events(queries: DataFrame, nodes: DataFrame, facets: DataFrame, namespace: str) -> DataFrame:
    """START and COMPLETE event of each query: (run_id, event_type, event_time, job_name, inputs, outputs, event).

    `queries` holds one row per query (query_id, transaction_id, session_id, start_time, end_time, query_txt). The
    column lineage is attached to the first output, as the event format offers no place for a target table.
    """
    sides = nodes.groupBy("query_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("role") == "input", F.col("node")))).alias("inputs"),
        F.array_sort(F.collect_set(F.when(F.col("role") == "output", F.col("node")))).alias("outputs"),
    )
    entry = F.struct("target_column", F.struct(F.col("input_fields").alias("inputFields")))
    columns = facets.groupBy("query_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("columns"))
    run_id = F.concat_ws("#", *(F.col(c).cast("string") for c in ("query_id", "transaction_id", "session_id")))
    joined = queries.join(sides, "query_id").join(columns, "query_id", "left").withColumn("run_id", run_id)
    lineage = F.when(
        F.col("columns").isNotNull(),
        _facet(COLUMN_PRODUCER, COLUMN_SCHEMA, F.col("columns").alias("fields")),
    )
    first = F.get("outputs", F.lit(0))
    outputs = F.transform(
        "outputs",
        lambda o, i: F.struct(
            o["namespace"].alias("namespace"),
            o["name"].alias("name"),
            F.struct(o["facets"]["schema"].alias("schema"), F.when(i == 0, lineage).alias("columnLineage")).alias("facets"),
        ),
    )
    phases = F.array(
        F.struct(F.lit("START").alias("event_type"), F.col("start_time").alias("event_time")),
        F.struct(F.lit("COMPLETE").alias("event_type"), F.col("end_time").alias("event_time")),
    )
    rows = joined.withColumn("outputs", F.when(first.isNotNull(), outputs)).withColumn("_phase", F.explode(phases))
    rows = rows.select("*", "_phase.*").withColumn("job_name", F.concat(F.lit(JOB_PREFIX), "run_id"))
    event = F.struct(
        F.col("event_type").alias("eventType"),
        F.col("event_time").cast("string").alias("eventTime"),
        F.struct(F.col("run_id").alias("runId")).alias("run"),
        F.struct(
            F.lit(namespace).alias("namespace"),
            F.col("job_name").alias("name"),
            F.struct(
                _facet(SQL_PRODUCER, SQL_SCHEMA, F.col("query_txt").alias("query")).alias("sql"),
                _facet(
                    QUERY_PRODUCER, JOB_TYPE_SCHEMA, F.lit(JOB_INTEGRATION).alias("integration"), F.lit("Query").alias("jobType")
                ).alias("jobType"),
            ).alias("facets"),
        ).alias("job"),
        "inputs",
        "outputs",
        F.lit(QUERY_PRODUCER).alias("producer"),
        F.lit(EVENT_SCHEMA).alias("schemaURL"),
    )
    return rows.select("run_id", "event_type", "event_time", "job_name", "inputs", "outputs", F.to_json(event).alias("event"))


# --- column paths and table edges -------------------------------------------------------------------------


def fine_grained(paths: DataFrame, platform: str, path: str = "path") -> DataFrame:
    """Split column paths (arrays of struct(table, column)) into the last column and those before it."""

    def urn(entry: Column) -> Column:
        return F.concat(F.lit(f"{platform}:"), entry["table"], F.lit("/"), entry["column"])

    steps = F.size(path)
    last = F.element_at(path, -1)
    before = F.slice(F.col(path), F.lit(1), F.greatest(steps - 1, F.lit(0)))
    return paths.filter(steps > 0).withColumns(
        {
            "downstream_table": last["table"],
            "downstream": urn(last),
            "upstreams": F.transform(before, urn),
            "upstream_tables": F.array_sort(F.array_distinct(F.transform(before, lambda e: e["table"]))),
        }
    ).drop(path)


def upstream_tables(fine: DataFrame) -> DataFrame:
    """Distinct (downstream table, upstream table) edges."""
    return fine.select("downstream_table", F.explode("upstream_tables").alias("upstream_table")).distinct()


def table_lineage(edges: DataFrame, target: str = "target_table", source: str = "source_table") -> DataFrame:
    """Sources of each target table; edges are distinct before they are listed."""
    return edges.select(target, source).distinct().groupBy(target).agg(F.array_sort(F.collect_list(source)).alias("sources"))


# --- events from job logs ---------------------------------------------------------------------------------


def log_messages(logs: DataFrame, marker: str = SPARK_MARKER) -> DataFrame:
    """Lines of the log events with, on marker lines, the text from the first `{` after the marker."""
    lines = logs.select("stream", "event_id", "timestamp", F.posexplode(F.split("message", "\n")).alias("line_no", "line"))
    found = F.locate(marker, F.col("line"))
    begin = F.position(F.lit("{"), F.col("line"), found + len(marker))
    return lines.withColumn("body", F.when((found > 0) & (begin > 0), F.substr("line", begin)))


def extract_log_events(
    logs: DataFrame, marker: str = SPARK_MARKER, stitch_ms: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Run events found in log messages: (complete, incomplete), both (stream, event_id, timestamp, event).

    `logs` has stream, event_id, timestamp (ms) and message. A body that does not parse is the head of a split event:
    its end is the first later line ending in `}` from another log event within `stitch_ms`. The lines between belong to
    the event if that parses; otherwise they are unrelated and head and end alone are tried. A line belongs to the
    latest head before it.
    """
    # Messages are split and parsed once; everything below reads the lines.
    parsed = F.col("body").isNotNull() & F.try_parse_json("body").isNotNull()
    lines = stored(log_messages(logs, marker).withColumn("_whole", parsed), "log-lines")
    whole = F.col("_whole")
    complete = lines.filter(whole).select("stream", "event_id", "timestamp", F.col("body").alias("event"))

    order = ["timestamp", "event_id", "line_no"]
    is_head = F.col("body").isNotNull()
    bucket = F.floor(F.col("timestamp") / stitch_ms).alias("_bucket")
    heads = lines.filter(is_head & ~whole).select("stream", "event_id", "timestamp", "line_no", "body")
    # Only lines close to a head can belong to one: few of a whole log, kept on shared storage for the steps below.
    near = heads.select("stream", F.explode(F.array(bucket, bucket + 1)).alias("_bucket")).distinct()
    rest = (
        lines.filter(~whole)
        .select("*", bucket)
        .join(near, ["stream", "_bucket"], "left_semi")
        .select("stream", *order, "line", "body")
    )
    rest = with_chunk(stored(rest, "near-lines"), "timestamp")
    head = F.when(is_head, F.struct(*order, "body"))
    placed = running_max(rest, ["stream"], order, head, "_head", strict=True).drop(CHUNK)
    in_reach = (
        ~is_head
        & F.col("_head").isNotNull()
        & (F.col("event_id") != F.col("_head.event_id"))
        & (F.col("timestamp") <= F.col("_head.timestamp") + stitch_ms)
    )
    heads = rest.filter(is_head).select("stream", "event_id", "timestamp", "line_no", "body")
    tails = placed.filter(in_reach).select(
        "stream",
        F.col("_head.event_id").alias("event_id"),
        F.col("_head.line_no").alias("line_no"),
        F.struct("timestamp", F.col("event_id").alias("tail_id"), F.col("line_no").alias("tail_no")).alias("at"),
        "line",
    )
    key = ["stream", "event_id", "line_no"]
    ends = tails.filter(F.col("line").endswith("}")).groupBy(*key).agg(F.min(F.struct("at", "line")).alias("end"))
    reach = tails.join(ends.select(*key, F.col("end.at").alias("end_at")), key).filter(F.col("at") <= F.col("end_at"))
    longer = reach.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "").alias("more")
    )
    joined = heads.join(ends, key, "left").join(longer, key, "left")
    full, short = F.concat("body", "more"), F.concat("body", "end.line")
    settled = joined.withColumn(
        "event",
        F.when(F.try_parse_json(full).isNotNull(), full).when(F.try_parse_json(short).isNotNull(), short),
    )
    found = settled.filter("event is not null").select("stream", "event_id", "timestamp", "event")
    missing = settled.filter("event is null").select("stream", "event_id", "timestamp", F.col("body").alias("event"))
    return complete.unionByName(found), missing


def since(logs: DataFrame, position_ms: int | None) -> DataFrame:
    """Log events at or after a position."""
    return logs if position_ms is None else logs.filter(F.col("timestamp") >= position_ms)


def next_position(logs: DataFrame, fallback_ms: int | None = None) -> int | None:
    """Start of the next search: one millisecond after the last event, or the given time if there is none."""
    last = logs.agg(F.max("timestamp")).head()[0]
    return fallback_ms if last is None else last + 1


# --- crawls -----------------------------------------------------------------------------------------------


def match_crawls(tables: DataFrame, crawls: DataFrame) -> DataFrame:
    """For each table the completed crawl of its crawler that was running when it was created.

    Of several such crawls the one that ended last counts. Among the crawls started before a table, one covers its
    creation exactly if the latest end does, so a running maximum finds it without pairing tables and crawls.
    `tables` has crawler and created_ms, `crawls` crawl_id, crawler, state, start_ms and end_ms.
    """
    payload = F.struct(*(F.col(f"`{c}`") for c in tables.columns))
    done = crawls.filter(F.col("state") == "COMPLETED").select(
        "crawler",
        F.col("start_ms").alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct("end_ms", "start_ms", "crawl_id").alias("_crawl"),
        F.lit(None).cast(tables.select(payload.alias("p")).schema["p"].dataType).alias("_table"),
    )
    asked = tables.filter(F.col("crawler").isNotNull()).select(
        "crawler",
        F.col("created_ms").alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(done.schema["_crawl"].dataType).alias("_crawl"),
        payload.alias("_table"),
    )
    events = with_chunk(done.unionByName(asked), "_at")
    carried = running_max(events, ["crawler"], ["_at", "_kind"], F.col("_crawl"), "_best").drop(CHUNK)
    hits = carried.filter((F.col("_kind") == 1) & (F.col("_best.end_ms") >= F.col("_at")))
    return hits.select("_table.*", "_best.crawl_id", "_best.start_ms", "_best.end_ms")


def crawl_lineage(
    tables: DataFrame,
    crawls: DataFrame,
    start_environment: Mapping[str, str] | None = None,
    complete_environment: Mapping[str, str] | None = None,
) -> DataFrame:
    """START (storage to crawler) and COMPLETE (crawler to catalog) events of the matched tables.

    `tables` also has database, table, location and columns (array of struct(name, type)). The environments become
    the run facet of their event.
    """
    matched = match_crawls(tables, crawls).withColumn("namespace", parent_path("location"))
    schema = _facet(CRAWL_PRODUCER, CRAWL_DATASET_SCHEMA, F.col("columns").alias("fields"))
    links = _facet(
        CRAWL_PRODUCER,
        SYMLINK_SCHEMA,
        F.array(
            F.struct(
                F.col("namespace"), F.concat_ws(".", "database", "table").alias("name"), F.lit("TABLE").alias("type")
            )
        ).alias("identifiers")
    )
    identity = F.map_from_entries(
        F.transform(
            "columns",
            lambda c: F.struct(
                c["name"],
                F.struct(
                    F.array(
                        F.struct(F.col("namespace"), F.col("table").alias("name"), c["name"].alias("field"))
                    ).alias("inputFields")
                ),
            ),
        )
    )

    def dataset(output: bool) -> Column:
        facets = [schema.alias("schema"), links.alias("symlinks")]
        if output:
            facets.append(_facet(CRAWL_PRODUCER, CRAWL_COLUMN_SCHEMA, identity.alias("fields")).alias("columnLineage"))
        return F.array(F.struct(F.col("namespace"), F.col("table").alias("name"), F.struct(*facets).alias("facets")))

    def run(environment: Mapping[str, str] | None) -> Column:
        parts = [F.col("crawl_id").alias("runId")]
        if environment:
            values = F.struct(*(F.lit(v).alias(k) for k, v in environment.items()))
            facet = _facet(CRAWL_PRODUCER, RUN_SCHEMA, values.alias("environment-properties"))
            parts.append(F.struct(facet.alias("environment-properties")).alias("facets"))
        return F.struct(*parts)

    job_type = _facet(
        CRAWL_PRODUCER,
        CRAWL_JOB_TYPE_SCHEMA,
        F.lit("BATCH").alias("processingType"),
        F.lit(CRAWL_INTEGRATION).alias("integration"),
        F.lit("JOB").alias("jobType"),
    )

    def event(kind: str, time: str, side: str, environment: Mapping[str, str] | None) -> Column:
        return F.to_json(
            F.struct(
                F.timestamp_millis(time).cast("string").alias("eventTime"),
                F.lit(CRAWL_PRODUCER).alias("producer"),
                F.lit(EVENT_SCHEMA).alias("schemaURL"),
                F.lit(kind).alias("eventType"),
                run(environment).alias("run"),
                F.struct(
                    F.lit(CRAWL_JOBS).alias("namespace"),
                    F.col("crawler").alias("name"),
                    F.struct(job_type.alias("jobType")).alias("facets"),
                ).alias("job"),
                dataset(side == "outputs").alias(side),
            )
        )

    both = F.array(
        F.struct(F.lit("START").alias("event_type"), event("START", "start_ms", "inputs", start_environment).alias("event")),
        F.struct(F.lit("COMPLETE").alias("event_type"), event("COMPLETE", "end_ms", "outputs", complete_environment).alias("event")),
    )
    return matched.withColumn("_e", F.explode(both)).select("database", "table", "crawl_id", "_e.*")
