"""Log structuring: multiline records, field extraction per log type, timestamps, routing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.ordered import _join
from lakeops.session import stored

# The pattern names used below, as published with the grok pattern library.
GROK = {
    "YEAR": r"(?:\d\d){1,2}",
    "MONTHNUM": r"(?:0?[1-9]|1[0-2])",
    "MONTHDAY": r"(?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])",
    "HOUR": r"(?:2[0123]|[01]?[0-9])",
    "MINUTE": r"(?:[0-5][0-9])",
    "SECOND": r"(?:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)",
    "ISO8601_TIMEZONE": r"(?:Z|[+-]%{HOUR}(?::?%{MINUTE}))",
    "TIMESTAMP_ISO8601": r"%{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?%{ISO8601_TIMEZONE}?",
    "TIMESTAMP_ICMS": r"%{YEAR}/%{MONTHNUM}/%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?%{ISO8601_TIMEZONE}?",
    "WORD": r"\b\w+\b",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
}

# The fields of a record, the start of one, the time zone of the sources and the index names.
FIELDS = ("timestamp", "level", "class", "thread", "traceId", "seqNo", "userId", "msg")
START_LINE = r"^\d{4}-\d{2}-\d{2}"
SOURCE_ZONE = "Asia/Shanghai"
INDEX_TEMPLATE = "s1-{subsystem}-{logs_topic}-{logs_type}-alias"


@dataclass(frozen=True)
class Rule:
    """A pattern for the log types of a topic. `either` names fields whose repeated captures exclude each other;
    for any other repeated field the last capture counts."""

    topic: str
    pattern: str
    types: tuple[str, ...] = ()
    other_than: tuple[str, ...] = ()
    either: tuple[str, ...] = ()

    def applies(self, topic: str = "logs_topic", kind: str = "logs_type") -> Column:
        hit = F.col(topic) == self.topic
        if self.types:
            hit = hit & F.col(kind).isin(*self.types)
        if self.other_than:
            hit = hit & ~F.col(kind).isin(*self.other_than)
        return hit


# One pattern per log type.
_LAZADA = r"%{TIMESTAMP_ISO8601:timestamp} \[%{DATA},%{DATA:traceId},%{DATA:seqNo},%{DATA}\] %{WORD:level}%{SPACE}+%{DATA:class} - %{GREEDYDATA:msg}"
_APSI = r"%{TIMESTAMP_ISO8601:timestamp} \[%{DATA:traceId}\] \[%{DATA} %{DATA} %{DATA} %{DATA} %{DATA:seqNo}\] \[%{DATA:thread}\] %{WORD:level}%{SPACE}+%{DATA:class} - %{GREEDYDATA:msg}"
_SEQUENCES = r"%{TIMESTAMP_ISO8601:timestamp} \[%{DATA:seqNo}\] \[%{DATA}\] \[%{DATA}\] %{WORD:level}%{SPACE}+\[%{DATA:thread}\] %{DATA:class}\s+%{GREEDYDATA:msg}"
_ENSEMBLE = r"%{TIMESTAMP_ISO8601:timestamp} %{WORD:level}%{SPACE}+\[%{DATA:thread}\] %{DATA:class} %{GREEDYDATA:msg}"
_ICMS = r"%{TIMESTAMP_ICMS:timestamp} %{WORD:level}%{SPACE}+\[%{DATA:thread}\|%{DATA:traceId}\] %{DATA:class} - %{GREEDYDATA:msg}"
_IBP = r"%{TIMESTAMP_ISO8601:timestamp}\|%{SPACE}+%{WORD:level}\|\s*%{DATA:traceId}\|\s*%{DATA:thread}\|\s*%{DATA:class} - %{GREEDYDATA:msg}"
_OCPAY = r"%{TIMESTAMP_ISO8601:timestamp}\|\s*%{WORD:level}\s*\|\s*%{DATA:traceId}\|\s*\[%{DATA} %{DATA} %{DATA} %{DATA} %{DATA:seqNo}\]?\|\s*%{DATA:thread}\|\s*%{DATA:class} - %{GREEDYDATA:msg}"
_BANKCLOUD = r"%{TIMESTAMP_ISO8601:timestamp}\s+%{WORD:level}\s+\[%{DATA:traceId}\]\s+\[%{DATA:thread}\]\s+%{DATA:class}\s*-\s*%{GREEDYDATA:msg}"
_APPOINTMENT = r"%{TIMESTAMP_ISO8601:timestamp}\s+\[%{DATA:traceId}\]\s+\[%{DATA:thread}\]\s+%{WORD:level}\s+%{DATA:class}\s*-\s*%{GREEDYDATA:msg}"
_BANKCLOUD_OR_APPOINTMENT = r"%{TIMESTAMP_ISO8601:timestamp}\s+(\[%{DATA:traceId}\]\s+\[%{DATA:thread}\]|%{WORD:level}\s+\[%{DATA:traceId}\]\s+\[%{DATA:thread}\])\s+%{WORD:level}\s+%{DATA:class}\s*-\s*%{GREEDYDATA:msg}"
_FTS_PROXY = r"%{TIMESTAMP_ISO8601:timestamp} \[%{DATA:thread}\] %{WORD:level}%{SPACE}+%{DATA:class} - %{GREEDYDATA:msg}"
_FTS_BATCH = r"%{TIMESTAMP_ISO8601:timestamp} \[%{DATA:thread}\] \[%{DATA:traceId}\] %{WORD:level}%{SPACE}+%{DATA:class} - %{GREEDYDATA:msg}"
_FTS = r"%{TIMESTAMP_ISO8601:timestamp} \[%{DATA:thread}\]( \[%{DATA:traceId}\])? %{WORD:level}%{SPACE}+%{DATA:class} - %{GREEDYDATA:msg}"
_WORKFLOW = r"%{TIMESTAMP_ISO8601:timestamp}\s+\[%{DATA:thread}\|%{DATA:traceId}\]\s*%{WORD:level}\s+%{DATA:class}\s*-\s*%{GREEDYDATA:msg}"
_GSAVE = r"%{TIMESTAMP_ISO8601:timestamp}\|\s*%{WORD:level}\|\s*%{DATA:traceId}\|%{DATA}\|\s*%{DATA:traceId}\|\s*%{DATA:class}\s*-\s*%{GREEDYDATA:msg}"
_RCMS = r"%{TIMESTAMP_ISO8601:timestamp} %{WORD:level}%{SPACE}+\[%{DATA:traceId}\] \[%{DATA:thread}\] \[%{DATA:class}\]- %{GREEDYDATA:msg}"
_SLP = r"%{TIMESTAMP_ISO8601:timestamp} %{WORD:level}%{SPACE}+\[%{DATA:traceId},%{DATA},%{DATA}\] \[%{DATA:thread}\] \[%{DATA:class}\]\s*- %{GREEDYDATA:msg}"
_CHMS_JOB = r"%{TIMESTAMP_ISO8601:timestamp}\s+%{WORD:level}\s+\[%{DATA:thread}\]\s+%{DATA:class}\s*[-:]\s*%{GREEDYDATA:msg}"
_CHMS = r"%{TIMESTAMP_ISO8601:timestamp}\s*%{WORD:level}\s*\[%{DATA:traceId},%{DATA:userId}\]\|%{DATA:thread}\|%{DATA:class}:\s*%{GREEDYDATA:msg}"
_CHMS_JOBS = ("chms-smn", "chms-job", "chms-arch")

_SHARED_TAIL = (
    Rule("rcms", _RCMS),
    Rule("slp", _SLP),
    Rule("chms", _CHMS_JOB, types=_CHMS_JOBS),
    Rule("chms", _CHMS, other_than=_CHMS_JOBS),
)

# Which pattern reads which topic and type.
RULES_BY_TYPE = (
    Rule("core", _LAZADA, ("cimb-lazada",)),
    Rule("core", _LAZADA, ("modelbank",)),
    Rule("core", _LAZADA, ("cimb-paylater",)),
    Rule("core", _APSI, ("apsi",)),
    Rule("core", _SEQUENCES, ("sequences",)),
    Rule("core", _ENSEMBLE, ("ensemble-om",)),
    Rule("core", _ICMS, ("icms",)),
    Rule("core", _ICMS, ("csn-server", "csn-schedule")),
    Rule("core", _IBP, ("ibp",)),
    Rule("core", _OCPAY, ("ocpay",)),
    Rule("core", _BANKCLOUD, ("bankcloud-check",)),
    Rule("core", _APPOINTMENT, ("appointment",)),
    Rule("core", _FTS_PROXY, ("fts-proxy",)),
    Rule("core", _FTS_BATCH, ("fts-batch",)),
    Rule("core", _WORKFLOW, ("icms-workflow",)),
    Rule("core", _GSAVE, ("gsave", "gcredit")),
    *_SHARED_TAIL,
)

# The same with similar types sharing a pattern. Lines of bankcloud-check carry one level only, which the shared
# pattern does not accept: they come out unmatched here, unlike with the rules by type. Fixed values as above.
RULES_MERGED = (
    Rule("core", _LAZADA, ("cimb-lazada", "modelbank", "cimb-paylater")),
    Rule("core", _FTS, ("fts-proxy", "fts-batch")),
    Rule("core", _ICMS, ("csn-server", "csn-schedule", "icms")),
    Rule("core", _GSAVE, ("gsave", "gcredit")),
    Rule("core", _APSI, ("apsi",)),
    Rule("core", _SEQUENCES, ("sequences",)),
    Rule("core", _ENSEMBLE, ("ensemble-om",)),
    Rule("core", _IBP, ("ibp",)),
    Rule("core", _OCPAY, ("ocpay",)),
    Rule("core", _BANKCLOUD_OR_APPOINTMENT, ("bankcloud-check", "appointment"), either=("traceId", "thread")),
    Rule("core", _WORKFLOW, ("icms-workflow",)),
    *_SHARED_TAIL,
)

# Time formats by topic and type.
_SLASH_TYPES = ("icms", "csn-server", "csn-schedule")
_COLON_TYPES = ("ibp", "gsave", "gcredit")
_POINT_TYPES = ("ocpay", "fts-proxy", "fts-batch", "appointment", "bankcloud-check", "icms-workflow")
_SLASH, _COLON, _POINT, _COMMA = (
    "yyyy/MM/dd HH:mm:ss:SSS",
    "yyyy-MM-dd HH:mm:ss:SSS",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss,SSS",
)
TIME_RULES = (
    (Rule("core", _SLASH, types=_SLASH_TYPES), _SLASH),
    (Rule("chms", _SLASH), _SLASH),
    (Rule("core", _COLON, types=_COLON_TYPES), _COLON),
    (Rule("core", _POINT, types=_POINT_TYPES), _POINT),
    (Rule("rcms", _POINT), _POINT),
    (Rule("slp", _POINT), _POINT),
    (Rule("core", _COMMA, other_than=_SLASH_TYPES + _COLON_TYPES + _POINT_TYPES), _COMMA),
)


def expand(pattern: str) -> tuple[str, dict[str, list[int]]]:
    """Regular expression of a grok pattern, and the capture group numbers of each field.

    A field that ends at a bracket, a bar, a comma or, inside brackets, a blank cannot hold that character, and blanks are matched in one
    way only. So a line that does not fit is given up after one pass for each time stamp in it.
    """
    pattern = pattern.replace("%{SPACE}+", "%{SPACE}")
    groups: dict[str, list[int]] = {}
    out, count, last = [], 0, 0
    for match in re.finditer(r"%\{(\w+)(?::(\w+))?\}", pattern):
        literal = pattern[last : match.start()]
        count += len(re.findall(r"(?<!\\)\((?!\?)", literal))
        out.append(literal)
        body = _nested(GROK[match.group(1)])
        if match.group(1) == "DATA":
            opened = pattern[: match.start()].rpartition("\\[")[2]
            body = _bounded(pattern[match.end() :], "\\]" not in opened and "\\[" in pattern[: match.start()])
        if match.group(2):
            count += 1
            groups.setdefault(match.group(2), []).append(count)
            out.append(f"({body})")
        else:
            out.append(f"(?:{body})")
        last = match.end()
    out.append(pattern[last:])
    # Blanks taken are never given back: what follows them begins with something else.
    return "".join(out).replace(r"\s+", r"\s++").replace(r"\s*", r"\s*+"), groups


def _bounded(rest: str, in_brackets: bool) -> str:
    """DATA up to the delimiter that `rest` begins with."""
    for delimiter in ("\\]?\\|", "\\]", "\\|", ",", *([" "] if in_brackets else [])):
        if rest.startswith(delimiter):
            return "[^" + delimiter.replace("?", "") + "\\n]*?"
    return GROK["DATA"]


def _nested(body: str) -> str:
    while "%{" in body:
        body = re.sub(r"%\{(\w+)\}", lambda m: GROK[m.group(1)], body)
    return body


# --- operators --------------------------------------------------------------------------------------------


def join_multiline(
    lines: DataFrame,
    path: str = "path",
    block: str = "block",
    order: str = "line_no",
    line: str = "line",
    start: str = START_LINE,
    max_lines: int | None = None,
) -> DataFrame:
    """Join continuation lines to the record they follow: (path, first_line, lines, message).

    A line matching `start` begins a record; lines before the first one form a record of their own. With `max_lines`, later lines of a
    record are dropped, as the collector does, and `truncated` tells so. `block` numbers must rise with `order` inside a file:
    windows run per block, and one row per block carries the open record on, so a file may be of any size.

    Lines are shuffled once, to their blocks, and joined there. Of the pieces made so, only those at the ends of blocks move again.
    """
    rows = Window.partitionBy(path, block).orderBy(order)
    placed = lines.select(path, block, order, line, F.row_number().over(rows).cast("bigint").alias("_row"))
    begins = F.max(F.when(F.col(line).rlike(start), F.col("_row"))).over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("_start", begins)
    # A piece is the part of a record in one block; without `_start` it goes on with a record of the blocks before.
    first = F.coalesce("_start", F.lit(1))
    kept = F.lit(True) if max_lines is None else F.col("_row") - first < max_lines
    texts = F.array_sort(F.collect_list(F.when(kept, F.struct("_row", F.col(line).alias("l")))))
    pieces = placed.groupBy(path, block, "_start").agg(F.count("*").alias("_n"), F.transform(texts, lambda x: x["l"]).alias("_texts"))
    pieces = stored(pieces, "log-pieces")
    # One row per block. Written too, so that its size is known and the pieces need not move to meet it.
    sizes = pieces.groupBy(path, block).agg(F.sum("_n").alias("_size"), F.max("_start").alias("_last"))
    before = Window.partitionBy(path).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0)) - 1)
    blocks = stored(blocks.withColumn("_open", F.coalesce(F.max(F.col("_base") + F.col("_last")).over(before), F.lit(0))), "log-blocks")
    at = _join(pieces, blocks, [path, block]).withColumns(
        {"first_line": F.coalesce(F.col("_base") + F.col("_start"), "_open"), "_at": F.col("_base") + first, "_whole": F.coalesce(F.col("_start") < F.col("_last"), F.lit(False))}
    )
    left = at if max_lines is None else at.withColumn("_texts", F.slice("_texts", 1, F.greatest(F.lit(0), max_lines + F.col("first_line") - F.col("_at")).cast("int")))
    parts = F.array_sort(F.collect_list(F.struct("_at", "_texts")))
    split = left.filter(~F.col("_whole")).groupBy(path, "first_line").agg(F.sum("_n").alias("_n"), F.flatten(F.transform(parts, lambda x: x["_texts"])).alias("_texts"))
    records = at.filter("_whole").select(path, "first_line", "_n", "_texts").unionByName(split)
    count = F.col("_n") if max_lines is None else F.least("_n", F.lit(max_lines).cast("bigint"))
    return records.select(path, "first_line", count.alias("lines"), F.array_join("_texts", "\n").alias("message"), (F.col("_n") > count).alias("truncated"))


def cap_bytes(df: DataFrame, column: str = "message", limit: int = 10240) -> DataFrame:
    """Cut records above a size limit in bytes, as the collector does, and flag them in `truncated`."""
    cut = F.make_valid_utf8(F.substring(F.col(column).cast("binary"), 1, limit).cast("string"))
    over = F.octet_length(column) > limit
    return df.withColumn("truncated", over).withColumn(column, F.when(over, cut).otherwise(F.col(column)))


def with_fields(df: DataFrame, **values: str) -> DataFrame:
    """Attach static fields."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


# Neither the marks nor their stand-ins are letters, digits or blanks, so patterns take them alike.
_STAND_INS = [("\x02", "\x02\x04"), ("\x01", "\x02\x03")]


def _swap(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def extract_fields(df: DataFrame, rules: Sequence[Rule] = RULES_BY_TYPE, message: str = "message") -> DataFrame:
    """Add the fields of the pattern that fits each line's topic and type, and `matched`.

    The chosen pattern runs once per line: it rewrites the line into the field values in a fixed order, which are
    then split. Without a match `msg` is the whole message. A pattern reads to the end of its line only. Marks between
    the values are control characters; a message that holds such a character is matched with a stand-in for it.
    """
    mark = "\x01"
    rewritten, odd = None, F.contains(F.col(message), F.lit(mark))
    line = F.when(odd, _swap(F.col(message), _STAND_INS)).otherwise(F.col(message))
    for rule in rules:
        regex, groups = expand(rule.pattern)
        layout = ""
        for name in FIELDS:
            numbers = groups.get(name, [])
            if name not in rule.either:
                numbers = numbers[-1:]
            layout += mark + "".join(f"${n}" for n in numbers)
        value = F.regexp_replace(line, f"^(?s:.*?){regex}(?s:.*)$", layout)
        rewritten = F.when(rule.applies(), value) if rewritten is None else rewritten.when(rule.applies(), value)
    values = F.split(rewritten, mark)
    back = [(new, old) for old, new in reversed(_STAND_INS)]
    parts = df.withColumn("_parts", F.when(odd, F.transform(values, lambda v: _swap(v, back))).otherwise(values))
    matched = F.coalesce((F.size("_parts") == len(FIELDS) + 1) & (F.get("_parts", F.lit(0)) == ""), F.lit(False))
    parts = parts.withColumn("matched", matched)
    fields = {
        name: F.when(F.col("matched"), F.nullif(F.get("_parts", F.lit(i + 1)), F.lit(""))) for i, name in enumerate(FIELDS)
    }
    fields["msg"] = F.when(F.col("matched"), F.get("_parts", F.lit(len(FIELDS)))).otherwise(F.col(message))
    return parts.withColumns(fields).drop("_parts")


def parse_times(
    df: DataFrame, rules: Sequence[tuple[Rule, str]] = TIME_RULES, zone: str = SOURCE_ZONE, text: str = "timestamp", out: str = "event_time"
) -> DataFrame:
    """Parse the time text by the format of its topic and type; the text is local time of `zone`."""
    value = None
    for rule, fmt in rules:
        parsed = F.try_to_timestamp(F.col(text), F.lit(fmt))
        value = F.when(rule.applies(), parsed) if value is None else value.when(rule.applies(), parsed)
    return df.withColumn(out, F.to_utc_timestamp(value, zone))


def finish(df: DataFrame, raw: Sequence[str] = ("message", "@version")) -> DataFrame:
    """Lower-case the log type and drop the raw fields."""
    return df.withColumn("logs_type", F.lower("logs_type")).drop(*raw)


def log_events(lines: DataFrame, source: str, time: Column, line: str = "line") -> DataFrame:
    """Non-blank lines as event records {timestamp, log_content, source}."""
    kept = lines.filter(F.trim(line) != "")
    return kept.select(time.cast("double").alias("timestamp"), F.trim(line).alias("log_content"), F.lit(source).alias("source"))
