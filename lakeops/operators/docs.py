"""Documents: extended-JSON unwrapping, ids, bulk actions, batched writes with dead letters, resumable loads."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.ordered import with_chunk, with_position
from lakeops.operators.tables import path_exists, read_text, _fs

# Single-key wrapper objects of extended JSON and the type inside.
NUMBER_WRAPPERS = {"$numberInt": "int", "$numberLong": "bigint", "$numberDouble": "double"}
TEXT_WRAPPERS = ("$oid",)
DATE_WRAPPER = "$date"


@dataclass(frozen=True)
class _Rules:
    dates: str = "raw"
    as_text: frozenset = field(default_factory=frozenset)
    as_string: frozenset = field(default_factory=frozenset)
    mixed: Mapping[str, str] = field(default_factory=dict)
    drop_empty: bool = False


def unwrap_extended_json(
    df: DataFrame,
    dates: str = "raw",
    as_text: Sequence[str] = (),
    as_string: Sequence[str] = (),
    mixed: Mapping[str, str] | None = None,
    drop_empty: bool = False,
) -> DataFrame:
    """Replace type-wrapper objects by plain columns, at any depth, from the schema alone.

    The text "null" and null list elements vanish. `dates="millis"` turns ISO dates into epoch milliseconds (as
    text; unreadable dates stay). Dotted paths in `as_text` keep their subtree as JSON text, in `as_string` keep a
    wrapped number as text. `mixed` names text columns that hold either a wrapper or a plain value, with the wanted
    type. `drop_empty` nulls objects without any value.
    """
    rules = _Rules(dates, frozenset(as_text), frozenset(as_string), dict(mixed or {}), drop_empty)
    return df.select(
        *(_plain(F.col(f"`{f.name}`"), f.dataType, (f.name,), rules).alias(f.name) for f in df.schema.fields)
    )


def _plain(value: Column, kind: T.DataType, path: tuple[str, ...], rules: _Rules) -> Column:
    dotted = ".".join(path)
    if dotted in rules.as_text:
        return F.to_json(value) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")
    if isinstance(kind, T.StructType):
        return _plain_object(value, kind, path, rules)
    if isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda x: _plain(x, kind.elementType, (*path, "*"), rules))
        return F.filter(items, lambda x: x.isNotNull())
    if isinstance(kind, T.StringType):
        text = F.when(value != "null", value)
        if dotted in rules.mixed:
            inner = [F.get_json_object(value, f"$['{w}']") for w in (*NUMBER_WRAPPERS, DATE_WRAPPER, *TEXT_WRAPPERS)]
            return F.coalesce(*inner, text).try_cast(rules.mixed[dotted])
        return text
    return value


def _plain_object(value: Column, kind: T.StructType, path: tuple[str, ...], rules: _Rules) -> Column:
    if len(kind.fields) == 1:
        name, inner = kind.fields[0].name, kind.fields[0].dataType
        content = value.getField(name)
        if name in NUMBER_WRAPPERS:
            if ".".join(path) in rules.as_string:
                return content.cast("string")
            return content.cast("string").try_cast(NUMBER_WRAPPERS[name])
        if name in TEXT_WRAPPERS:
            return content.cast("string")
        if name == DATE_WRAPPER:
            if isinstance(inner, T.StructType):
                return _plain_object(content, inner, path, rules)
            if rules.dates == "millis":
                millis = F.unix_millis(F.try_to_timestamp(content.cast("string")))
                return F.coalesce(millis.cast("string"), content.cast("string"))
            return content
    parts = [(f.name, _plain(value.getField(f.name), f.dataType, (*path, f.name), rules)) for f in kind.fields]
    whole = F.struct(*(c.alias(n) for n, c in parts))
    present = value.isNotNull()
    if rules.drop_empty and parts:
        present = present & F.coalesce(*(c.isNotNull() | F.lit(None) for _, c in parts), F.lit(False))
    return F.when(present, whole)


def with_document_id(df: DataFrame, source: str = "_id", out: str = "doc_key") -> DataFrame:
    """Document id: the object id, else the plain id, else a hash of the content; the source column is dropped.

    A content hash stays the same when a load is repeated, so repeated loads overwrite instead of adding.
    """
    rest = [c for c in df.columns if c != source]
    content = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rest))), 256)
    if source not in df.columns:
        return df.withColumn(out, content)
    kind = df.schema[source].dataType
    if isinstance(kind, T.StructType) and "$oid" in kind.fieldNames():
        known = F.col(source).getField("$oid")
    else:
        known = F.coalesce(F.get_json_object(F.col(source).cast("string"), "$['$oid']"), F.col(source).cast("string"))
    return df.withColumn(out, F.coalesce(known, content)).drop(source)


def bulk_actions(df: DataFrame, index: str | Column, id_col: str = "doc_key") -> DataFrame:
    """Index actions: `_index`, `_id` and the remaining columns as JSON in `_source` (nulls left out)."""
    target = F.lit(index) if isinstance(index, str) else index
    rest = [F.col(f"`{c}`") for c in df.columns if c != id_col]
    return df.select(target.alias("_index"), F.col(id_col).cast("string").alias("_id"), F.to_json(F.struct(*rest)).alias("_source"))


def with_batches(df: DataFrame, size: int, order: str) -> DataFrame:
    """Number the rows in `order` into batches of exactly `size`; only the last is smaller."""
    placed = with_position(with_chunk(df, order), [], [order]).drop("_chunk")
    return placed.withColumn("batch", F.floor(F.col("pos") / size)).drop("pos")


# --- bulk write -------------------------------------------------------------------------------------------

Writer = Callable[[list[dict]], tuple[int, int]]

STATS = (
    "partition int, batch int, docs int, ok int, failed int, seconds double, error string, dead_letter string"
)

_STATS = pa.schema(
    [(n, pa.int32()) for n in ("partition", "batch", "docs", "ok", "failed")] + [("seconds", pa.float64()), ("error", pa.string()), ("dead_letter", pa.string())]
)
# What a task holds beside its open batch: rows of a page as objects, and characters of dead letters.
_ROWS_AT_ONCE, _LETTERS_AT_ONCE = 100, 4_000_000


@contextmanager
def _small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Documents go to the tasks' Python a thousand at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bulk_write(
    actions: DataFrame, writer: Callable[[], Writer], batch_size: int, report_path: str, dead_letter_path: str | None = None
) -> DataFrame:
    """Send actions in batches from the executors and return one statistics row per batch.

    `writer()` runs once per task and returns a function from a list of `{_index, _id, _source}` to (ok, failed).
    A batch that raises becomes a dead letter with its error, time, index and documents. The statistics are
    written once to `report_path`, so reading them again does not send anything again; a retried task may,
    which stable ids make harmless.
    """

    def send(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write, task = writer(), TaskContext.get().partitionId()
        pending: list[dict] = []
        done: list[dict] = []
        number = held = 0

        def flush() -> dict:
            started, error, letter = time.time(), None, None
            try:
                ok, failed = write(pending)
            except Exception as cause:  # recorded below with its documents
                ok, failed, error = 0, len(pending), str(cause)
                letter = json.dumps(
                    {
                        "error": error,
                        "timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
                        "index": pending[0]["_index"],
                        "data": [{**json.loads(a["_source"]), "_id": a["_id"]} for a in pending],
                    }
                )
            return {
                "partition": task, "batch": number, "docs": len(pending), "ok": ok, "failed": failed,
                "seconds": time.time() - started, "error": error, "dead_letter": letter,
            }

        for page in pages:
            for start in range(0, page.num_rows, _ROWS_AT_ONCE):
                for action in page.slice(start, _ROWS_AT_ONCE).to_pylist():
                    pending.append(action)
                    if len(pending) >= batch_size:
                        done.append(flush())
                        held += len(done[-1]["dead_letter"] or "")
                        pending, number = [], number + 1
                        if len(done) >= 1000 or held >= _LETTERS_AT_ONCE:
                            yield pa.RecordBatch.from_pylist(done, _STATS)
                            done, held = [], 0
        if pending:
            done.append(flush())
        if done:
            yield pa.RecordBatch.from_pylist(done, _STATS)

    spark = actions.sparkSession
    with _small_batches(spark):
        actions.select("_index", "_id", "_source").mapInArrow(send, STATS).write.mode("append").parquet(report_path)
    report = spark.read.schema(STATS).parquet(report_path)
    if dead_letter_path:
        letters = report.filter(F.col("dead_letter").isNotNull())
        letters.select(F.col("dead_letter").alias("value")).write.mode("append").text(dead_letter_path)
    return report.drop("dead_letter")


# --- resume -----------------------------------------------------------------------------------------------


def save_state(spark: SparkSession, path: str, position: int, processed: int, completed: bool) -> None:
    """Record how far a load has come."""
    state = {
        "position": position,
        "processed_docs": processed,
        "timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
        "completed": completed,
    }
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()


def load_state(spark: SparkSession, path: str) -> dict | None:
    return json.loads(read_text(spark, path)) if path_exists(spark, path) else None


def resumable_load(
    actions: DataFrame,
    position: str,
    writer: Callable[[], Writer],
    batch_size: int,
    state_path: str,
    report_path: str,
    rows_per_step: int,
    dead_letter_path: str | None = None,
) -> DataFrame:
    """Load in steps of position ranges and record the position after each; a restart goes on from there.

    The step that was running when a load died is sent again. `position` must be a number that orders the rows.
    """
    spark = actions.sparkSession
    state = load_state(spark, state_path) or {"position": None, "processed_docs": 0, "completed": False}
    ends = actions.agg(F.min(position).alias("lo"), F.max(position).alias("hi"), F.count("*").alias("n")).head()
    start, processed = ends["lo"], state["processed_docs"]
    if state["position"] is not None:
        start = state["position"] + 1
    # Width of a step in position units, from the average density.
    width = max(1, int(rows_per_step * max(1, (ends["hi"] or 0) - (ends["lo"] or 0) + 1) / max(1, ends["n"])))
    while ends["n"] and start <= ends["hi"] and not state["completed"]:
        stop = min(start + width - 1, ends["hi"])
        step = actions.filter(F.col(position).between(start, stop))
        stats = bulk_write(step, writer, batch_size, f"{report_path}/from={start}", dead_letter_path)
        processed += stats.agg(F.sum("docs")).head()[0] or 0
        save_state(spark, state_path, stop, processed, stop == ends["hi"])
        start = stop + 1
    return spark.read.schema(STATS + ", from bigint").parquet(report_path).drop("dead_letter", "from")
