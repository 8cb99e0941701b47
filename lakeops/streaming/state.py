"""Keyed streaming state: counts over the live rows of a change stream, and events stitched from split log lines."""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lakeops.operators import lineage
from lakeops.operators.tables import _remove, list_dirs, path_exists

BUCKETS = 1024  # of keys; a checkpoint holds for one number of them

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Keyed state of several variables is kept in RocksDB: on local disk, with its changes in the checkpoint folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


# --- counts over live rows --------------------------------------------------------------------------------


def _rank(row: Row | dict, order: Sequence[str]) -> tuple:
    return tuple((row[c] is not None, row[c]) for c in order)


def _plain(value):
    """A key's value in the form a dictionary finds again."""
    if isinstance(value, bytearray):
        return bytes(value)
    return value if value == value else "NaN"


class _LiveRows(StatefulProcessor):
    """The last change of each key of a bucket, read and written together. A change takes back what the row before added to its group and adds
    the new row."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], by: Sequence[str], sums: Sequence[str], kept: Sequence[str]):
        self.keys, self.order, self.by, self.sums, self.kept = list(keys), list(order), list(by), list(sums), list(kept)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getValueState("rows", "data binary")

    def _part(self, row: dict, sign: int) -> Row:
        values = {c: row[c] for c in self.by} | {"rows": sign} | {c: None if row[c] is None else sign * row[c] for c in self.sums}
        return Row(**values)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        last: dict[tuple, tuple[tuple, Row]] = {}
        for row in rows:
            name, rank = tuple(_plain(row[c]) for c in self.keys), _rank(row, self.order)
            if name not in last or rank > last[name][0]:
                last[name] = rank, row
        held = pickle.loads(self.rows.get()[0]) if self.rows.exists() else {}
        parts = []
        for name, (rank, row) in last.items():
            if name in held:
                old = dict(zip(self.kept, held[name], strict=True))
                if _rank(old, self.order) > rank:
                    continue
                if old["live"]:
                    parts.append(self._part(old, -1))
            held[name] = tuple(row[c] for c in self.kept)
            if row["live"]:
                parts.append(self._part(row, 1))
        self.rows.update((pickle.dumps(held),))
        yield from parts

    def close(self) -> None:
        pass


def last_of_batch(keys: Sequence[str], order: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each key in a batch of rows the last by order: a hot key leaves a task as a few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            places = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")
            table = table.take(places)
            keep = ~table.select(keys).to_pandas().duplicated(keep="last")
            yield from table.filter(pa.array(keep.to_numpy())).combine_chunks().to_batches()

    return run


def live_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str], by: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """A stream of routed changes (`action` and data) as additions to groups: the `by` columns, rows (+1 or -1) and the sums.

    Event order decides, in whatever order changes come: the state keeps each key's last change, deletes too, so an older one that comes later
    adds nothing. A repeated change takes back what it added. Keys share the state of a bucket: a call into Python and its exchange with the state
    store cost far more than a row does.
    """
    prepare(changes.sparkSession)
    kept = list(dict.fromkeys([*order, *by, *sums]))
    rows = changes.select(*dict.fromkeys([*keys, *kept]), (F.col("action") != "delete").alias("live"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    fewer = rows.mapInArrow(last_of_batch(keys, order), shape)
    buckets = fewer.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)))
    out = T.StructType([*(rows.schema[c] for c in by), T.StructField("rows", T.LongType()), *(rows.schema[c] for c in sums)])
    return buckets.groupBy("_bucket").transformWithState(_LiveRows(keys, order, by, sums, [*kept, "live"]), out, "append", "none")


def _batch_folder(batch_id: int) -> str:
    return f"batch={batch_id:012d}"


def _whole(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_dirs(spark, path) if n.startswith("batch=") and path_exists(spark, f"{path}/{n}/_SUCCESS")]


def start_live_counts(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], by: Sequence[str], path: str, checkpoint: str, sums: Sequence[str] = (), interval: str | None = None
) -> StreamingQuery:
    """Keep rows and sums per group of the live rows. Each batch writes the totals up to it in a folder of its own, from those of the batch before,
    so a repeated batch writes the same; the folder before is kept for it and for readers, older ones go.
    """
    spark = changes.sparkSession
    deltas = live_changes(changes, keys, order, by, sums)
    totals = [F.sum("rows").alias("rows"), *(F.sum(c).alias(c) for c in sums)]

    def add(batch: DataFrame, batch_id: int) -> None:
        earlier = [n for n in _whole(spark, path) if n < _batch_folder(batch_id)]
        if earlier:
            batch = batch.unionByName(spark.read.schema(deltas.schema).parquet(f"{path}/{earlier[-1]}"))
        batch.groupBy(*by).agg(*totals).select(*(F.col(f.name).cast(f.dataType) for f in deltas.schema.fields)).write.mode("overwrite").parquet(f"{path}/{_batch_folder(batch_id)}")
        for old in earlier[:-1]:
            _remove(spark, f"{path}/{old}")

    writer = deltas.writeStream.outputMode("append").foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def live_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest totals of groups that have rows."""
    return spark.read.parquet(f"{path}/{_whole(spark, path)[-1]}").filter("rows > 0")


# --- stitched log events ----------------------------------------------------------------------------------


def _no(value: str) -> None:
    raise ValueError(value)


def _once(pairs: list[tuple]) -> dict:
    if len(dict(pairs)) < len(pairs):
        raise ValueError("a name twice")
    return dict(pairs)


def _parses(text: str) -> bool:
    try:
        json.loads(text, parse_constant=_no, object_pairs_hook=_once)
    except (ValueError, RecursionError):
        return False
    return True


_LINE = "timestamp bigint, event_id string, line_no int, line string, body string"
_FOUND = "stream string, event_id string, timestamp bigint, event string, complete boolean"


def settle(lines: list[tuple], until: int, stitch_ms: int) -> tuple[list[tuple], list[tuple]]:
    """Events of the heads that can get no more lines at time `until`, and the lines that a head may still need.

    `lines` are (timestamp, event_id, line_no, line, body), sorted; a body marks a head. See `lineage.extract_log_events` for the rules.
    """
    found = []
    for i, (at, event_id, _, _, body) in enumerate(lines):
        if body is None or at + stitch_ms >= until:
            continue
        more, last = [], None
        # By place: a slice would copy all later lines for each head.
        for place in range(i + 1, len(lines)):
            when, other, _, line, head = lines[place]
            if head is not None or when > at + stitch_ms:
                break
            if other != event_id:
                more.append(line)
                if line.endswith("}"):
                    last = line
                    break
        tries = [body + "".join(more), body + last] if last is not None else []
        event = next((t for t in tries if _parses(t)), None)
        found.append((event_id, at, body if event is None else event, event is not None))
    return found, [x for x in lines if x[0] + stitch_ms >= until]


class _Stitcher(StatefulProcessor):
    """The lines of one log stream that a head may still need. Event-time timers settle heads once the watermark has passed their reach."""

    def __init__(self, stitch_ms: int):
        self.stitch_ms = stitch_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", _LINE)

    def _advance(self, key, lines: list[tuple], until: int) -> Iterator[Row]:
        found, rest = settle(sorted(lines, key=lambda x: x[:3]), until, self.stitch_ms)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if rest:
            self.lines.put(rest)
            self.handle.registerTimer(rest[0][0] + self.stitch_ms + 1)
        else:
            self.lines.clear()
        for event_id, at, event, complete in found:
            yield Row(stream=key[0], event_id=event_id, timestamp=at, event=event, complete=complete)

    def _held(self) -> list[tuple]:
        return [tuple(x) for x in self.lines.get()] if self.lines.exists() else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        new = [(r["timestamp"], r["event_id"], r["line_no"], r["line"], r["body"]) for r in rows]
        yield from self._advance(key, [*self._held(), *new], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        yield from self._advance(key, self._held(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def stitched_events(logs: DataFrame, marker: str = lineage.SPARK_MARKER, stitch_ms: int = 100, late: str = "10 seconds") -> DataFrame:
    """Run events of a stream of log messages (stream, event_id, timestamp in ms, message): stream, event_id, timestamp, event, complete.

    Events that parse go straight through. Other lines wait in their log stream's state until the watermark, `late` behind the latest message, has passed the
    reach of every head they could belong to; a head whose event does not parse by then is given out as incomplete. So the state holds the lines of a
    time span, and messages may come in any order within `late`.
    """
    prepare(logs.sparkSession)
    lines = lineage.log_messages(logs, marker)
    parsed = F.col("body").isNotNull() & F.try_parse_json("body").isNotNull()
    whole = lines.filter(parsed).select("stream", "event_id", "timestamp", F.col("body").alias("event"), F.lit(True).alias("complete"))
    timed = lines.filter(~parsed).withColumn("at", F.timestamp_millis("timestamp")).withWatermark("at", late)
    waiting = timed.groupBy("stream").transformWithState(_Stitcher(stitch_ms), _FOUND, "append", "eventTime")
    return whole.unionByName(waiting)


def start_batches(rows: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream's rows, each batch in a folder of its own, which a repeated batch writes anew."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{_batch_folder(batch_id)}")

    writer = rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all whole batches."""
    folders = [f"{path}/{n}" for n in _whole(spark, path)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
