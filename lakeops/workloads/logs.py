"""Log queries: lines of every log type built from `events`, multiline records from `documents`."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import logs, sinks
from lakeops.session import part_count, spread, table, work_path
from lakeops.sources import readers

# One line layout per log type. {d} date, {s} slash date, {t} time, {ms} milliseconds.
LAYOUTS = [
    ("core", "cimb-lazada", "{d} {t},{ms} [app,{traceId},{seqNo},x] {level}  {class} - {msg}"),
    ("core", "modelbank", "{d} {t},{ms} [app,{traceId},{seqNo},x] {level} {class} - {msg}"),
    ("core", "cimb-paylater", "{d} {t},{ms} [,{traceId},{seqNo},] {level} {class} - {msg}"),
    ("core", "fts-proxy", "{d} {t}.{ms} [{thread}] {level}  {class} - {msg}"),
    ("core", "fts-batch", "{d} {t}.{ms} [{thread}] [{traceId}] {level} {class} - {msg}"),
    ("core", "icms", "{s} {t}:{ms} {level}  [{thread}|{traceId}] {class} - {msg}"),
    ("core", "csn-server", "{s} {t}:{ms} {level} [{thread}|{traceId}] {class} - {msg}"),
    ("core", "gsave", "{d} {t}:{ms}| {level}| first|x| {traceId}| {class} - {msg}"),
    ("core", "apsi", "{d} {t},{ms} [{traceId}] [a b c d {seqNo}] [{thread}] {level}  {class} - {msg}"),
    ("core", "sequences", "{d} {t},{ms} [{seqNo}] [x] [y] {level}  [{thread}] {class} {msg}"),
    ("core", "ensemble-om", "{d} {t},{ms} {level}  [{thread}] {class} {msg}"),
    ("core", "ibp", "{d} {t}:{ms}| {level}| {traceId}| {thread}| {class} - {msg}"),
    ("core", "ocpay", "{d} {t}.{ms}| {level} | {traceId}| [a b c d {seqNo}]| {thread}| {class} - {msg}"),
    ("core", "bankcloud-check", "{d} {t}.{ms} {level} [{traceId}] [{thread}] {class} - {msg}"),
    ("core", "appointment", "{d} {t}.{ms} [{traceId}] [{thread}] {level} {class} - {msg}"),
    ("core", "icms-workflow", "{d} {t}.{ms} [{thread}|{traceId}] {level} {class} - {msg}"),
    ("rcms", "RCMS-web", "{d} {t}.{ms} {level}  [{traceId}] [{thread}] [{class}]- {msg}"),
    ("slp", "slp-app", "{d} {t}.{ms} {level} [{traceId},a,b] [{thread}] [{class}] - {msg}"),
    ("chms", "chms-job", "{d} {t}.{ms} {level} [{thread}] {class} - {msg}"),
    ("chms", "chms-web", "{d} {t}.{ms} {level} [{traceId},{userId}]|{thread}|{class}: {msg}"),
]
_NOISE = len(LAYOUTS)  # events with this remainder become lines no pattern fits

_VALUES = {
    "level": "case when event_type = 'error' then 'ERROR' else 'INFO' end",
    "class": "concat('com.acme.Job', cast(user_id % 9 as {text}))",
    "thread": "concat('pool-', cast(user_id % 8 as {text}))",
    "traceId": "concat('t', cast(event_id as {text}))",
    "seqNo": "concat('s', cast(user_id as {text}))",
    "userId": "concat('u', cast(user_id as {text}))",
    "msg": "concat(event_type, ' - ', props)",
}
_SPARK = {k: v.format(text="string") for k, v in _VALUES.items()} | {
    "d": "date_format(ts, 'yyyy-MM-dd')",
    "s": "date_format(ts, 'yyyy/MM/dd')",
    "t": "date_format(ts, 'HH:mm:ss')",
    "ms": "lpad(cast(unix_millis(cast(ts as timestamp)) % 1000 as string), 3, '0')",
}
_DUCK = {k: v.format(text="varchar") for k, v in _VALUES.items()} | {
    "d": "strftime(ts, '%Y-%m-%d')",
    "s": "strftime(ts, '%Y/%m/%d')",
    "t": "strftime(ts, '%H:%M:%S')",
    "ms": "lpad(cast(epoch_us(ts) // 1000 % 1000 as varchar), 3, '0')",
}


def _concat(layout: str, values: dict[str, str]) -> str:
    pieces = re.split(r"\{(\w+)\}", layout)
    return "concat(" + ", ".join(values[p] if i % 2 else f"'{p}'" for i, p in enumerate(pieces) if p) + ")"


def _by_type(column, other: str) -> str:
    cases = " ".join(f"when {i} then {column(i)}" for i in range(len(LAYOUTS)))
    return f"case event_id % {_NOISE + 1} {cases} else {other} end"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    noise = "concat('??? ', props)"
    return spread(table(spark, sf, "events")).select(
        "event_id",
        F.lit("shop").alias("subsystem"),
        F.expr(_by_type(lambda i: f"'{LAYOUTS[i][0]}'", "'core'")).alias("logs_topic"),
        F.expr(_by_type(lambda i: f"'{LAYOUTS[i][1]}'", "'apsi'")).alias("logs_type"),
        F.expr(_by_type(lambda i: _concat(LAYOUTS[i][2], _SPARK), noise)).alias("message"),
    )


def extracted(spark: SparkSession, sf: str, rules=logs.RULES_BY_TYPE) -> DataFrame:
    found = logs.finish(logs.extract_fields(_lines(spark, sf), rules))
    return found.select("event_id", "logs_type", F.col("matched").cast("int").alias("matched"), *logs.FIELDS)


def times(spark: SparkSession, sf: str) -> DataFrame:
    parsed = logs.parse_times(logs.extract_fields(_lines(spark, sf)))
    return parsed.select("event_id", F.unix_millis("event_time").alias("event_ms"))


def routed(spark: SparkSession, sf: str) -> DataFrame:
    done = logs.finish(logs.extract_fields(_lines(spark, sf)))
    return sinks.route_index(done, logs.INDEX_TEMPLATE).groupBy("index_name").agg(
        F.count("*").alias("records"), F.count_if("matched").alias("matched")
    )


def _document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each document is a record: a dated first line, then its text lines."""
    first = F.concat(F.lit("2024-01-01 00:00:00,000 doc "), F.col("doc_id").cast("string"))
    # A text line that looks like a date would start a record of its own, which is right for a log.
    return table(spark, sf, "documents").select(
        F.col("source").alias("path"),
        F.floor(F.col("doc_id") / 256).alias("block"),
        "doc_id",
        F.posexplode(F.concat(F.array(first), F.split("text", "\n"))).alias("i", "line"),
    ).select("path", "block", (F.col("doc_id") * 1_000_000 + F.col("i")).alias("line_no"), "line")


def multiline(spark: SparkSession, sf: str) -> DataFrame:
    records = logs.join_multiline(_document_lines(spark, sf))
    return records.select("path", "first_line", "lines", F.length("message").cast("bigint").alias("chars"), F.md5("message").alias("digest"))


def multiline_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same from log files on disk, read in blocks."""
    path = work_path(spark, "logs")
    lines = _document_lines(spark, sf).withColumn("doc", F.floor(F.col("line_no") / 1_000_000))
    # Files are cut between documents, as a rotated log is cut between records.
    ordered = lines.repartitionByRange(part_count(table(spark, sf, "documents"), 4), "path", "doc").sortWithinPartitions("path", "line_no")
    ordered.select("path", F.col("line").alias("value")).write.partitionBy("path").text(path)
    back = readers.log_lines(spark, path)
    records = logs.join_multiline(back)
    return records.agg(F.count("*").alias("records"), F.sum("lines").alias("lines"), F.sum(F.length("message")).alias("chars"))


def capped(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.col("text").alias("message"))
    cut = logs.cap_bytes(rows, limit=1024)
    return cut.select("doc_id", F.col("truncated").cast("int").alias("truncated"), F.when(~F.col("truncated"), F.md5("message")).alias("digest"),
                      (F.octet_length("message") <= 1026).cast("int").alias("fits"))


def events_out(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    records = logs.log_events(logs.with_fields(lines, server="a1"), "documents", F.col("doc_id"))
    return records.groupBy("timestamp", "source").agg(F.count("*").alias("events"), F.sum(F.length("log_content")).alias("chars"))


QUERIES = {
    "logs_extract": extracted,
    "logs_extract_merged": lambda spark, sf: extracted(spark, sf, logs.RULES_MERGED),
    "logs_times": times,
    "logs_route": routed,
    "logs_multiline": multiline,
    "logs_multiline_files": multiline_files,
    "logs_capped": capped,
    "logs_events": events_out,
}


def _expected(field: str, merged: bool) -> str:
    """The value the layout put into the line, stated from the base columns rather than by pattern."""

    def value(i: int) -> str:
        topic, kind, layout = LAYOUTS[i]
        if merged and kind == "bankcloud-check":
            return _concat(layout, _DUCK) if field == "msg" else "null"
        if field == "timestamp":
            return _concat(layout.split("{ms}")[0] + "{ms}", _DUCK)
        return _DUCK[field] if f"{{{field}}}" in layout else "null"

    return _by_type(value, "concat('??? ', props)" if field == "msg" else "null")


def _extract_sql(merged: bool) -> str:
    hit = _by_type(lambda i: "0" if merged and LAYOUTS[i][1] == "bankcloud-check" else "1", "0")
    kinds = _by_type(lambda i: f"'{LAYOUTS[i][1].lower()}'", "'apsi'")
    fields = ", ".join(f"{_expected(f, merged)} as \"{f}\"" for f in logs.FIELDS)
    return f"select event_id, {kinds} as logs_type, cast({hit} as integer) as matched, {fields} from events"


_DOC_RECORDS = """with l as (select source as path, doc_id, unnest(list_prepend('2024-01-01 00:00:00,000 doc ' || doc_id, string_split(text, chr(10)))) as line,
      generate_subscripts(list_prepend('', string_split(text, chr(10))), 1) as i from documents),
  p as (select *, row_number() over (partition by path order by doc_id, i) - 1 as pos from l),
  s as (select *, coalesce(max(case when regexp_matches(line, '^\\d{4}-\\d{2}-\\d{2}') then pos end) over (partition by path order by pos), 0) as first_line from p),
  r as (select path, first_line, count(*) as lines, string_agg(line, chr(10) order by pos) as message from s group by 1, 2) """

ORACLE = {
    "logs_extract": _extract_sql(False),
    "logs_extract_merged": _extract_sql(True),
    "logs_times": f"""select event_id, {_by_type(lambda i: "null" if LAYOUTS[i][0] == "chms" else "epoch_us(ts) // 1000 - 28800000", "null")} as event_ms from events""",
    "logs_route": f"""select 's1-shop-' || {_by_type(lambda i: f"'{LAYOUTS[i][0]}-{LAYOUTS[i][1].lower()}'", "'core-apsi'")} || '-alias' as index_name,
      count(*) as records, count(*) filter (where event_id % {_NOISE + 1} < {_NOISE}) as matched from events group by 1""",
    "logs_multiline": _DOC_RECORDS + "select path, first_line, lines, length(message) as chars, md5(message) as digest from r",
    "logs_multiline_files": _DOC_RECORDS
    + "select count(*) as records, cast(sum(lines) as bigint) as lines, cast(sum(length(message)) as bigint) as chars from r",
    "logs_capped": """select doc_id, cast(strlen(text) > 1024 as integer) as truncated, case when strlen(text) <= 1024 then md5(text) end as digest, 1 as fits
      from documents""",
    "logs_events": """select cast(doc_id as double) as timestamp, 'documents' as source, count(*) as events, cast(sum(length(trim(line, ' '))) as bigint) as chars
      from (select doc_id, unnest(string_split(text, chr(10))) as line from documents) where trim(line, ' ') <> '' group by 1""",
}
