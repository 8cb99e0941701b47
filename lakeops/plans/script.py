"""Run parameterised SQL scripts and time query suites."""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FAILED = -999.0  # fixed value: marks a failed statement in a timing report

_PIECES = re.compile(
    r"""(?P<text>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`)|(?P<note>--[^\n]*|/\*.*?\*/)|(?P<end>;)""", re.S
)


class ScriptError(RuntimeError):
    """A statement failed; `index` counts from 1."""

    def __init__(self, index: int, statement: str, cause: Exception):
        super().__init__(f"statement {index} failed: {cause}\n{statement[:500]}")
        self.index = index
        self.statement = statement


def split_statements(text: str) -> list[str]:
    """Statements between semicolons that are not inside quotes or comments; comments and blanks are dropped."""
    out, current, last = [], [], 0
    for match in _PIECES.finditer(text):
        current.append(text[last : match.start()])
        if match.lastgroup == "text":
            current.append(match.group())
        elif match.lastgroup == "note":
            current.append(" ")
        else:
            out.append("".join(current))
            current = []
        last = match.end()
    out.append("".join(current) + text[last:])
    return [s.strip() for s in out if s.strip()]


def parse_params(pairs: str | Iterable[str]) -> dict[str, str]:
    """`KEY=VALUE` pairs from a list or a text separated by `;` or `,`. Nothing is ever evaluated."""
    items = re.split(r"[;,]", pairs) if isinstance(pairs, str) else pairs
    params = {}
    for item in items:
        if not item.strip():
            continue
        name, sign, value = item.partition("=")
        if not sign or not name.strip().isidentifier():
            raise ValueError(f"expected KEY=VALUE, got {item!r}")
        params[name.strip()] = value.strip().strip("'\"")
    return params


def substitute(statement: str, params: Mapping[str, str]) -> str:
    """Fill `{NAME}` and `${NAME}`; an unknown name is an error."""

    def fill(match: re.Match) -> str:
        name = match.group(1)
        if name not in params:
            raise KeyError(f"no value for {match.group()}")
        return str(params[name])

    return re.sub(r"\$?\{([A-Za-z_]\w*)\}", fill, statement)


def run_script(
    spark: SparkSession,
    text: str,
    params: Mapping[str, str] | None = None,
    database: str | None = None,
    on_result: Callable[[int, DataFrame], None] | None = None,
) -> DataFrame | None:
    """Run all statements in order and return the last one's result; `on_result` sees each (to show it, say)."""
    if database:
        spark.catalog.setCurrentDatabase(database)
    result = None
    for index, statement in enumerate(split_statements(text), 1):
        try:
            result = spark.sql(substitute(statement, params or {}))
            if on_result:
                on_result(index, result)
        except Exception as cause:
            raise ScriptError(index, statement, cause) from cause
    return result


def run_script_file(spark: SparkSession, path: str, params=None, database: str | None = None) -> DataFrame | None:
    return run_script(spark, spark.read.text(path, wholetext=True).head()[0], params, database)


def bytes_read(spark: SparkSession, run: Callable[[], None]) -> int:
    """Bytes that the tasks of `run` read from storage, as Spark's own task metrics say: columns and row groups that are skipped do not count."""
    context, group = spark.sparkContext, f"measured-{uuid.uuid4().hex}"
    context.setJobGroup(group, "bytes read")
    # Ranges that Parquet reads in threads of its own are not in the tasks' metrics.
    vectored = "parquet.hadoop.vectored.io.enabled"
    before = spark.conf.get(vectored, None)
    spark.conf.set(vectored, "false")
    try:
        run()
    finally:
        spark.conf.unset(vectored) if before is None else spark.conf.set(vectored, before)
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    tracker, jvm = context.statusTracker(), context._jsc.sc()
    jvm.listenerBus().waitUntilEmpty()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    store, total = jvm.statusStore(), 0
    for stage in stages:
        attempts = store.stageData(stage, False, getattr(store, "stageData$default$3")(), False, getattr(store, "stageData$default$5")())
        total += sum(attempts.apply(i).inputBytes() for i in range(attempts.size()))
    return total


def time_statement(spark: SparkSession, statement: str) -> dict:
    """Run one statement to the end without keeping its rows; `gigabytes` is what its tasks read."""
    started = time.time()
    try:
        df = spark.sql(statement)
        seen = Observation()
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows")) if df.columns else df
        read = bytes_read(spark, lambda: watched.write.format("noop").mode("overwrite").save()) if df.columns else 0
        return {
            "rows": int(seen.get["rows"]) if df.columns else 0,
            "gigabytes": round(read / 1024**3, 9),
            "seconds": round(time.time() - started, 3),
            "ok": True,
            "error": None,
        }
    except Exception as cause:
        return {"rows": 0, "gigabytes": FAILED, "seconds": FAILED, "ok": False, "error": str(cause)[:500]}


SUITE_SCHEMA = (
    "file string, statement int, rows bigint, gigabytes double, seconds double, ok boolean, error string"
)


def run_suite(spark: SparkSession, directory: str, params: Mapping[str, str] | None = None) -> DataFrame:
    """Time every statement of every script in a folder, in file-name order; a failure does not stop the suite."""
    scripts = (
        spark.read.text(directory, wholetext=True, recursiveFileLookup=True)
        .select(F.col("_metadata.file_path").alias("file"), "value")
        .collect()  # script texts only
    )
    report = []
    for script in sorted(scripts, key=lambda r: r["file"]):
        for index, statement in enumerate(split_statements(script["value"]), 1):
            name = os.path.basename(script["file"])
            try:
                outcome = time_statement(spark, substitute(statement, params or {}))
            except KeyError as cause:
                outcome = {"rows": 0, "gigabytes": FAILED, "seconds": FAILED, "ok": False, "error": str(cause)}
            report.append({"file": name, "statement": index, **outcome})
    return spark.createDataFrame(report, SUITE_SCHEMA)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing: one row per table or view."""
    rows = [
        (t.database or (t.namespace[-1] if t.namespace else None), t.name, t.tableType, t.isTemporary)
        for t in spark.catalog.listTables(database)
    ]
    return spark.createDataFrame(rows, "database string, name string, kind string, temporary boolean")


def list_databases(spark: SparkSession) -> DataFrame:
    rows = [(d.name, d.locationUri) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "database string, location string")
