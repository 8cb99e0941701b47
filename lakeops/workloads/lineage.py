"""Lineage queries: conversations are queries told in parts, `events` are job logs and crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.text import unescape
from lakeops.operators import lineage
from lakeops.session import spread, stored, table

_NAMESPACE = "warehouse://host:5439"
_KINDS = ["DDL", "CTAS", "COPY", "INSERT", "UNLOAD", "SELECT"]
_MARK = lineage.SPARK_MARKER


def _history(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    queries = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    return queries.select(
        F.col("conv_id").alias("query_id"),
        (F.col("conv_id") % 7).alias("user_id"),
        (F.col("conv_id") * 10).alias("transaction_id"),
        (F.col("conv_id") % 100).alias("session_id"),
        (F.col("conv_id") * 1000).alias("start_time"),
        (F.col("conv_id") * 1000 + F.col("last") * 10).alias("end_time"),
        F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("conv_id") % 6 + 1).cast("int")).alias("query_type"),
    )


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("query_id"), F.col("turn").alias("sequence"), F.concat("text", F.lit("  ")).alias("text")
    )


def _details(spark: SparkSession, sf: str) -> DataFrame:
    """Each query touches the tables its turns name: nation (conv_id + turn) modulo 25."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("query_id"), ((F.col("conv_id") + F.col("turn")) % 25).cast("int").alias("table_id")
    )


def _tables(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("table_id"),
        F.lit("dev").alias("database"),
        F.lower("r_name").alias("schema"),
        F.lower("n_name").alias("table"),
        F.lit("TABLE").alias("table_type"),
    )


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.query_history(_history(spark, sf), _parts(spark, sf), _details(spark, sf), _tables(spark, sf))


def query_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = _queries(spark, sf)
    return rows.select(
        "database", "schema", "table", "table_type", "user_id", "query_id", "transaction_id", "session_id",
        "start_time", "end_time", F.md5("query_txt").alias("digest"), F.length("query_txt").cast("bigint").alias("chars"),
    )


def _one_row_per_query(spark: SparkSession, sf: str) -> DataFrame:
    """A query's default database and schema are those of its first table."""
    rows = _queries(spark, sf)
    names = rows.groupBy("query_id").agg(F.min(F.struct("database", "schema", "table_type")).alias("d"))
    per_query = rows.drop("database", "schema", "table", "table_type").distinct()
    return per_query.join(names, "query_id").select("*", "d.*").drop("d")


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    """One column edge per turn; odd turns leave out the database, every third the schema."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("query_id"),
        F.concat(F.lit("out"), (F.col("turn") % 3).cast("string")).alias("target_column"),
        F.concat(F.lit("tgt"), (F.col("conv_id") % 5).cast("string")).alias("target_table"),
        F.when(F.col("turn") % 2 == 0, "lake").alias("source_database"),
        F.when(F.col("turn") % 3 != 0, "raw").alias("source_schema"),
        F.concat(F.lit("src"), ((F.col("conv_id") + F.col("turn")) % 11).cast("string")).alias("source_table"),
        F.col("role").alias("source_column"),
    )


def columns(spark: SparkSession, sf: str) -> DataFrame:
    found = lineage.column_lineage(_edges(spark, sf), _one_row_per_query(spark, sf), _NAMESPACE)
    return found.select("query_id", "target_column", F.explode("input_fields").alias("f")).select(
        "query_id", "target_column", "f.namespace", "f.name", "f.field"
    )


def _schema_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Three columns for each source table name used without a database in `raw`, in `lake.raw`."""
    turns = table(spark, sf, "conversations")
    number = turns.select(((F.col("conv_id") + F.col("turn")) % 11).alias("n")).distinct()
    spread = number.withColumn("position", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return spread.select(
        F.lit("lake").alias("database"), F.lit("raw").alias("schema"), F.concat(F.lit("src"), F.col("n").cast("string")).alias("table"),
        F.concat(F.lit(" c"), F.col("position").cast("string")).alias("column"), F.lit("int ").alias("type"), "position",
    )


def _touched(spark: SparkSession, sf: str) -> DataFrame:
    edges = _edges(spark, sf)
    inputs = edges.select(
        "query_id", F.lit("input").alias("role"), F.col("source_database").alias("database"), F.col("source_schema").alias("schema"),
        F.col("source_table").alias("table"),
    )
    nothing = F.lit(None).cast("string")
    outputs = edges.select(
        "query_id", F.lit("output").alias("role"), nothing.alias("database"), nothing.alias("schema"), F.col("target_table").alias("table")
    )
    return inputs.unionByName(outputs)


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    found = lineage.dataset_nodes(_touched(spark, sf), _one_row_per_query(spark, sf), _schema_columns(spark, sf), _NAMESPACE)
    fields = F.col("node.facets.schema.fields")
    listed = F.array_join(F.transform(fields, lambda f: F.concat(f["name"], F.lit(":"), f["type"])), ",")
    return found.select("query_id", "role", "name", listed.alias("fields"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    queries = stored(_one_row_per_query(spark, sf), "queries")
    found = lineage.dataset_nodes(_touched(spark, sf), queries, _schema_columns(spark, sf), _NAMESPACE)
    facets = lineage.column_lineage(_edges(spark, sf), queries, _NAMESPACE)
    return lineage.run_events(queries, found, facets, _NAMESPACE)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select(
        "run_id", "event_type", "event_time", "job_name",
        F.size("inputs").cast("bigint").alias("inputs"), F.size("outputs").cast("bigint").alias("outputs"),
        F.get_json_object("event", "$.outputs[0].name").alias("output"),
        F.length(F.get_json_object("event", "$.job.facets.sql.query")).cast("bigint").alias("chars"),
        F.get_json_object("event", "$.outputs[0].facets.columnLineage.fields.out0.inputFields[0].name").alias("first_input"),
    )


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    """Column paths of three steps from staging through a layer to the target."""
    step = lambda t, c: F.struct(t.alias("table"), c.alias("column"))
    edges = _edges(spark, sf)
    middle = F.concat(F.lit("mid"), (F.col("query_id") % 3).cast("string"))
    return edges.select(
        "query_id",
        F.array(
            step(F.col("source_table"), F.col("source_column")), step(middle, F.col("source_column")), step(F.col("target_table"), F.col("target_column"))
        ).alias("path"),
    )


def fine_grained(spark: SparkSession, sf: str) -> DataFrame:
    rows = lineage.fine_grained(_paths(spark, sf), "warehouse")
    return rows.select(
        "query_id", "downstream", F.array_join("upstreams", "|").alias("upstreams"), F.array_join("upstream_tables", "|").alias("tables")
    )


def upstream_edges(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.upstream_tables(lineage.fine_grained(_paths(spark, sf), "warehouse"))


def table_sources(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.table_lineage(_edges(spark, sf)).select("target_table", F.array_join("sources", ",").alias("sources"))


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    """Job logs: whole events, events split in two or three parts, and heads that never end."""
    source = spread(table(spark, sf, "events")).select(
        F.concat(F.lit("job-"), (F.col("event_id") % 256).cast("string")).alias("stream"),
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        (F.col("event_id") % 5).alias("kind"),
        F.concat(F.lit(f"10:00 {_MARK}{{\"run\":\""), F.col("event_id").cast("string"), F.lit('",')).alias("head"),
        F.concat(F.lit('"type":"'), F.col("event_type"), F.lit('",')).alias("middle"),
        F.concat(F.lit('"n":'), F.col("props"), F.lit("}")).alias("tail"),
    )
    whole = F.concat(F.lit("starting\n"), "head", "middle", "tail", F.lit("\nno event here }"))
    part = lambda offset, suffix, text: F.struct(
        F.lit(offset).alias("offset"), F.lit(suffix).alias("suffix"), text.alias("message")
    )
    noise = F.lit("heartbeat")
    parts = (
        F.when(
            F.col("kind") == 0,
            F.array(part(0, "a", F.concat("head", "middle")), part(10, "b", noise), part(20, "c", F.col("tail"))),
        )
        .when(F.col("kind") == 1, F.array(part(0, "a", F.concat("head", "middle")), part(500, "b", F.col("tail"))))
        .when(
            F.col("kind") == 2, F.array(part(0, "a", F.col("head")), part(5, "b", F.col("middle")), part(9, "c", F.concat("tail", F.lit("\nafter"))))
        )
        .otherwise(F.array(part(0, "a", whole)))
    )
    return source.select("stream", "event_id", "ms", F.explode(parts).alias("p")).select(
        "stream",
        F.concat(F.lpad(F.col("event_id").cast("string"), 12, "0"), "p.suffix").alias("event_id"),
        (F.col("ms") + F.col("p.offset")).alias("timestamp"),
        "p.message",
    )


def log_events(spark: SparkSession, sf: str) -> DataFrame:
    complete, missing = lineage.extract_log_events(_logs(spark, sf))
    shown = complete.select(
        "stream", F.lit("complete").alias("state"), F.get_json_object("event", "$.run").alias("run"),
        F.get_json_object("event", "$.type").alias("type"), F.get_json_object("event", "$.n.k").cast("bigint").alias("k"),
    )
    heads = missing.select(
        "stream", F.lit("incomplete").alias("state"), F.regexp_extract("event", r'"run":"(\d+)"', 1).alias("run"),
        F.lit(None).cast("string").alias("type"), F.lit(None).cast("bigint").alias("k"),
    )
    return shown.unionByName(heads)


def log_position(spark: SparkSession, sf: str) -> DataFrame:
    """High-water mark per stream and the rows a second search would see."""
    logs = _logs(spark, sf)
    marks = logs.groupBy("stream").agg(F.max("timestamp").alias("last"), F.count("*").alias("events"))
    return marks.select("stream", (F.col("last") + 1).alias("next_ms"), "events")


def _crawl_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    base = spread(table(spark, sf, "events")).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    crawler = F.concat(F.lit("crawler-"), (F.col("user_id") % 3).cast("string"))
    crawls = base.filter("event_type in ('click', 'purchase')").select(
        F.concat(F.lit("c"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("crawl_id"),
        crawler.alias("crawler"),
        F.when(F.col("value") > 5, "COMPLETED").otherwise("FAILED").alias("state"),
        F.col("ms").alias("start_ms"),
        (F.col("ms") + (F.col("value") * 20000).cast("bigint")).alias("end_ms"),
    )
    column = lambda n, t: F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"))
    tables = base.filter("event_type in ('view', 'signup', 'error')").select(
        F.lit("db1").alias("database"),
        F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("table"),
        F.col("ms").alias("created_ms"),
        F.concat(F.lit("s3://bucket/zone/"), F.col("event_id").cast("string"), F.lit("/")).alias("location"),
        F.array(column("id", "bigint"), column("v", "string")).alias("columns"),
        F.when(F.col("event_type") != "error", crawler).alias("crawler"),
    )
    return tables, crawls


def crawl_match(spark: SparkSession, sf: str) -> DataFrame:
    found = lineage.match_crawls(*_crawl_inputs(spark, sf))
    return found.select("table", "crawler", "crawl_id", "created_ms", "start_ms", "end_ms")


def crawl_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = lineage.crawl_lineage(*_crawl_inputs(spark, sf))
    return rows.select(
        "table", "event_type",
        F.get_json_object("event", "$.run.runId").alias("run"),
        F.get_json_object("event", "$.job.name").alias("job"),
        F.coalesce(F.get_json_object("event", "$.inputs[0].namespace"), F.get_json_object("event", "$.outputs[0].namespace")).alias("namespace"),
        F.get_json_object("event", "$.outputs[0].facets.columnLineage.fields.v.inputFields[0].name").alias("from_table"),
    )


def unescaped(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line breaks written as backslash sequences, and back."""
    escaped = F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.md5(unescape(escaped)).alias("digest"))
    return rows


QUERIES = {
    "lineage_query_text": query_text,
    "lineage_columns": columns,
    "lineage_nodes": nodes,
    "lineage_events": events,
    "lineage_fine_grained": fine_grained,
    "lineage_upstream_tables": upstream_edges,
    "lineage_table_sources": table_sources,
    "lineage_log_events": log_events,
    "lineage_log_position": log_position,
    "lineage_crawl_match": crawl_match,
    "lineage_crawl_events": crawl_events,
    "lineage_unescape": unescaped,
}

_BASE = """history as (select conv_id as query_id, conv_id % 7 as user_id, conv_id * 10 as transaction_id, conv_id % 100 as session_id,
    conv_id * 1000 as start_time, conv_id * 1000 + max(turn) * 10 as end_time,
    (['DDL', 'CTAS', 'COPY', 'INSERT', 'UNLOAD', 'SELECT'])[conv_id % 6 + 1] as query_type from conversations group by conv_id),
  texts as (select conv_id as query_id, string_agg(rtrim(text || '  ', ' '), '' order by turn, text) as query_txt from conversations group by 1),
  tabs as (select n_nationkey as table_id, 'dev' as database, lower(r_name) as schema, lower(n_name) as "table", 'TABLE' as table_type
    from nation, region where n_regionkey = r_regionkey),
  q as (select distinct database, schema, "table", table_type, user_id, h.query_id, transaction_id, session_id, start_time, end_time, query_txt
    from history h left join texts on h.query_id = texts.query_id left join
      (select conv_id as query_id, (conv_id + turn) % 25 as table_id from conversations) d on h.query_id = d.query_id
    join tabs on d.table_id = tabs.table_id where query_type <> 'SELECT'),
  one as (select distinct q.query_id, transaction_id, session_id, start_time, end_time, query_txt, d.schema as dschema from q,
    (select query_id, min(schema) as schema from q group by 1) d where q.query_id = d.query_id),
  edges as (select conv_id as query_id, 'out' || (turn % 3) as target_column, 'tgt' || (conv_id % 5) as target_table,
    case when turn % 2 = 0 then 'lake' end as sdb, case when turn % 3 <> 0 then 'raw' end as ss,
    'src' || ((conv_id + turn) % 11) as source_table, role as source_column from conversations),
  named as (select distinct e.query_id, target_column, coalesce(sdb, 'dev') as db, coalesce(ss, dschema) as sch, source_table, source_column
    from edges e join one on e.query_id = one.query_id),
  nodes as (select distinct query_id, 'input' as role, db || '.' || sch || '.' || source_table || '.TABLE' as name,
      case when db = 'lake' and sch = 'raw' then 'c1:int,c2:int,c3:int' else '' end as fields from named
    union all select distinct e.query_id, 'output', 'dev.' || dschema || '.' || target_table || '.TABLE', '' from edges e join one on e.query_id = one.query_id)"""

_CRAWLS = """crawls as (select 'c' || lpad(cast(event_id as varchar), 12, '0') as crawl_id, 'crawler-' || (user_id % 3) as crawler,
    epoch_us(ts) // 1000 as start_ms, epoch_us(ts) // 1000 + cast(trunc(value * 20000) as bigint) as end_ms
    from events where event_type in ('click', 'purchase') and value > 5),
  tabs as (select 't' || event_id as "table", 'crawler-' || (user_id % 3) as crawler, epoch_us(ts) // 1000 as created_ms
    from events where event_type in ('view', 'signup')),
  m as (select "table", t.crawler, crawl_id, created_ms, start_ms, end_ms,
      row_number() over (partition by "table" order by end_ms desc, start_ms desc, crawl_id desc) as r
    from tabs t join crawls c on t.crawler = c.crawler and start_ms <= created_ms and end_ms >= created_ms)"""

ORACLE = {
    "lineage_query_text": f"""with {_BASE} select database, schema, "table", table_type, user_id, query_id, transaction_id, session_id,
      start_time, end_time, md5(query_txt) as digest, length(query_txt) as chars from q""",
    "lineage_columns": f"""with {_BASE} select query_id, target_column, '{_NAMESPACE}' as namespace, db || '.' || sch || '.' || source_table as name,
      source_column as field from named""",
    "lineage_nodes": f"with {_BASE} select query_id, role, name, fields from nodes",
    "lineage_events": f"""with {_BASE}, sides as (select query_id, count(*) filter (where role = 'input') as inputs, count(*) filter (where role = 'output') as outputs,
        min(name) filter (where role = 'output') as output from nodes group by 1),
      firsts as (select query_id, min(db || '.' || sch || '.' || source_table) as first_input from named where target_column = 'out0' group by 1),
      runs as (select one.*, query_id || '#' || transaction_id || '#' || session_id as run_id from one)
      select run_id, p.event_type, case when p.event_type = 'START' then start_time else end_time end as event_time, '{lineage.JOB_PREFIX}' || run_id as job_name,
        inputs, outputs, output, length(query_txt) as chars, first_input
      from runs join sides using (query_id) left join firsts using (query_id), (values ('START'), ('COMPLETE')) p(event_type)""",
    "lineage_fine_grained": f"""with {_BASE} select query_id, 'warehouse:' || target_table || '/' || target_column as downstream,
        'warehouse:' || source_table || '/' || source_column || '|warehouse:mid' || (query_id % 3) || '/' || source_column as upstreams,
        'mid' || (query_id % 3) || '|' || source_table as tables from edges""",
    "lineage_upstream_tables": f"""with {_BASE} select distinct target_table as downstream_table, unnest([source_table, 'mid' || (query_id % 3)]) as upstream_table from edges""",
    "lineage_table_sources": f"""with {_BASE} select target_table, string_agg(distinct source_table, ',' order by source_table) as sources from edges group by 1""",
    "lineage_log_events": """select 'job-' || (event_id % 256) as stream, case when event_id % 5 = 1 then 'incomplete' else 'complete' end as state,
      cast(event_id as varchar) as run, case when event_id % 5 <> 1 then event_type end as type,
      case when event_id % 5 <> 1 then cast(regexp_extract(props, '([0-9]+)', 1) as bigint) end as k from events""",
    "lineage_log_position": """select 'job-' || (event_id % 256) as stream,
      max(epoch_us(ts) // 1000 + case event_id % 5 when 0 then 20 when 1 then 500 when 2 then 9 else 0 end) + 1 as next_ms,
      cast(sum(case event_id % 5 when 0 then 3 when 1 then 2 when 2 then 3 else 1 end) as bigint) as events from events group by 1""",
    "lineage_crawl_match": f'with {_CRAWLS} select "table", crawler, crawl_id, created_ms, start_ms, end_ms from m where r = 1',
    "lineage_crawl_events": f"""with {_CRAWLS} select "table", p.event_type, crawl_id as run, crawler as job, 's3://bucket/zone' as namespace,
      case when p.event_type = 'COMPLETE' then "table" end as from_table from m, (values ('START'), ('COMPLETE')) p(event_type) where r = 1""",
    "lineage_unescape": "select conv_id, turn, md5(text) as digest from conversations",
}
