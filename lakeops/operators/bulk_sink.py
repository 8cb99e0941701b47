"""A bulk load as a Spark sink: `df.write.format("bulk_load")` and `stream.writeStream.format("bulk_load")`.

Tasks send their rows in batches and give Spark a short report when they end; Spark hands the reports of those task attempts that count to the commit, once. So
a task that is lost and tried again, or run twice by speculation, is counted once, and dead letters of attempts that do not count are dropped. What it had
sent is sent again, which stable ids make harmless.

A load has a name (in a stream: the number of the micro-batch). A load that is committed again takes the place of the one before. Below the sink's path:
`report/load=<name>/` one row a task, written last, so it marks a finished load; `letters/load=<name>/` the dead letters; `_staging/` files of running tasks.
An empty input gives a report without rows. A path belongs to one stream, or to tables whose loads have different names.
"""

from __future__ import annotations

import base64
import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

NAME = "bulk_load"
ACTION = ("_index", "_id", "_source")
REPORT = "load string, partition int, batches bigint, docs bigint, ok bigint, failed bigint, refused bigint, seconds double"
LETTERS = "load string, error string, timestamp string, index string, id string, source string"


class Unavailable(Exception):
    """The target can't be reached: the task fails and Spark tries it again. Any other error of a batch makes dead letters of its documents."""


class Refused(Exception):
    """Some documents of a batch were not taken: `reasons` by id. The others were."""

    def __init__(self, reasons: dict[str, str]):
        super().__init__(f"{len(reasons)} refused")
        self.reasons = reasons


@dataclass
class TaskReport(WriterCommitMessage):
    partition: int
    batches: int = 0
    docs: int = 0
    ok: int = 0
    failed: int = 0
    refused: int = 0
    seconds: float = 0.0
    letters: str | None = None


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


class _Letters:
    """The dead letters of one task attempt, in a file of its own that is made with the first letter."""

    def __init__(self, folder: str, partition: int):
        self.folder, self.name, self.out = folder, f"part-{partition:05d}-{uuid.uuid4().hex}.json", None

    def add(self, error: str, actions: Iterable[dict]) -> None:
        if self.out is None:
            files, folder = _open(self.folder)
            files.create_dir(folder)
            self.out = files.open_output_stream(f"{folder}/{self.name}")
        now = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
        for a in actions:
            letter = {"error": error, "timestamp": now, "index": a["_index"], "id": a["_id"], "source": a["_source"]}
            self.out.write(json.dumps(letter).encode() + b"\n")

    def close(self) -> str | None:
        if self.out is None:
            return None
        self.out.close()
        return self.name


class _Load:
    """What tasks, commit and abort do; the same for tables and micro-batches."""

    def __init__(self, options: dict[str, str]):
        self.path, self.size = options["path"].rstrip("/"), int(options["batch_size"])
        self.writer, self.name = options["writer"], options.get("load")
        # Spark makes a stream's writer anew for its commit, so the folder has a fixed name there; a stream runs one batch at a time.
        self.staging = f"{self.path}/_staging/{uuid.uuid4().hex if self.name else 'stream'}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskReport:
        report = TaskReport(TaskContext.get().partitionId())
        letters = _Letters(self.staging, report.partition)
        send, pending, started = None, [], time.time()

        def flush() -> None:
            report.batches += 1
            report.docs += len(pending)
            try:
                ok, failed = send(pending)
            except Unavailable:
                raise
            except Refused as cause:
                ok, failed = len(pending) - len(cause.reasons), len(cause.reasons)
                report.refused += failed
                for action in pending:
                    if action["_id"] in cause.reasons:
                        letters.add(cause.reasons[action["_id"]], [action])
            except Exception as cause:  # kept with its documents
                ok, failed = 0, len(pending)
                report.refused += failed
                letters.add(str(cause), pending)
            report.ok += ok
            report.failed += failed

        for batch in iterator:
            for action in batch.select(list(ACTION)).to_pylist():
                send = send or cloudpickle.loads(base64.b64decode(self.writer))()
                pending.append(action)
                if len(pending) == self.size:
                    flush()
                    pending = []
        if pending:
            flush()
        report.letters, report.seconds = letters.close(), time.time() - started
        return report

    def place(self, messages: list[TaskReport | None], name: str) -> None:
        files, root = _open(self.path)
        _, staging = _open(self.staging)
        report, letters = f"{root}/report/load={name}", f"{root}/letters/load={name}"
        for folder in (report, letters):
            if files.get_file_info(folder).type == pafs.FileType.Directory:
                files.delete_dir(folder)
        done = [m for m in messages if m is not None]
        files.create_dir(letters)
        for m in done:
            if m.letters:
                files.move(f"{staging}/{m.letters}", f"{letters}/{m.letters}")
        files.create_dir(report)
        with files.open_output_stream(f"{report}/_tasks.json") as out:
            for m in done:
                out.write(json.dumps({k: v for k, v in asdict(m).items() if k != "letters"}).encode() + b"\n")
        files.move(f"{report}/_tasks.json", f"{report}/tasks.json")
        self.clear()

    def clear(self) -> None:
        files, staging = _open(self.staging)
        if files.get_file_info(staging).type == pafs.FileType.Directory:
            files.delete_dir(staging)


class _TableWriter(_Load, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self.place(messages, self.name)

    def abort(self, messages: list) -> None:
        self.clear()


class _StreamWriter(_Load, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.place(messages, str(batchId))

    def abort(self, messages: list, batchId: int) -> None:
        self.clear()


class BulkSink(DataSource):
    """Options: `path`, `batch_size`, `writer` (see `packed`) and, for tables, `load`."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> _TableWriter:
        if overwrite:
            raise ValueError("a load adds to the target: use mode append")
        return _TableWriter(dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(dict(self.options))


def packed(writer: Callable[[], Callable[[list[dict]], tuple[int, int]]]) -> str:
    """A writer factory as an option's text. `writer()` runs once a task that has rows and returns a function from a list of actions to (ok, failed)."""
    return base64.b64encode(cloudpickle.dumps(writer)).decode()


def _options(spark: SparkSession, writer: Callable, batch_size: int, path: str) -> dict[str, str]:
    spark.dataSource.register(BulkSink)
    return {"path": path, "batch_size": str(batch_size), "writer": packed(writer)}


def load(actions: DataFrame, writer: Callable, batch_size: int, path: str, name: str) -> DataFrame:
    """Send index actions as the load `name` and return its report, a row a task. `path` must be one that all executors reach."""
    spark = actions.sparkSession
    options = _options(spark, writer, batch_size, path)
    actions.select(*ACTION).write.format(NAME).options(**options, load=name).mode("append").save()
    return report(spark, path).filter(f"load = '{name}'")


def start(actions: DataFrame, writer: Callable, batch_size: int, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """The same for a stream: each micro-batch is a load, and one that is repeated after a failure counts once."""
    options = _options(actions.sparkSession, writer, batch_size, path)
    out = actions.select(*ACTION).writeStream.format(NAME).options(**options).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)).start()


def report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).json(f"{path}/report")


def letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LETTERS).json(f"{path}/letters")
