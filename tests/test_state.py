from __future__ import annotations

import json
import random
from decimal import Decimal

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import lineage, metrics
from lakeops.session import work_path
from lakeops.sources.readers import file_stream
from lakeops.streaming import jobs, state


def test_last_of_batch():
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 1, None, None], "t": [5, None, 3, 1, 2], "v": ["a", "b", "c", "d", "e"]})
    got = pa.Table.from_batches(state.last_of_batch(["k"], ["t"])(iter([batch]))).to_pylist()
    assert sorted(r["v"] for r in got) == ["a", "b", "e"]


SHAPE = "action string, ts int, id int, grp string, n int"


def test_counts_in_any_order(spark):
    """Every prefix of the batches gives the counts of the rows that are live by then."""
    rng = random.Random(4)
    changes = [(rng.choice(["upsert", "upsert", "delete"]), ts, rng.randrange(6), rng.choice("ab") if ts % 7 else None, ts) for ts in range(60)]
    rng.shuffle(changes)
    folder, root, seen = work_path(spark, "in"), work_path(spark, "s"), []
    for start in range(0, 60, 20):
        part = changes[start : start + 20]
        seen += part
        spark.createDataFrame(part, SHAPE).repartition(2).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, "parquet", SHAPE, max_files=1)
        state.start_live_counts(stream, ["id"], ["ts"], ["grp"], f"{root}/c", jobs.checkpoint_path(root, "c"), ["n"]).awaitTermination()
        last = {}
        for c in sorted(seen, key=lambda c: c[1]):
            last[c[2]] = c
        want = {}
        for action, _, _, grp, n in last.values():
            if action != "delete":
                want[grp] = (want.get(grp, (0, 0))[0] + 1, want.get(grp, (0, 0))[1] + n)
        assert {r["grp"]: (r["rows"], r["n"]) for r in state.live_counts(spark, f"{root}/c").collect()} == want
    assert len(state._whole(spark, f"{root}/c")) == 2


def test_keys_share_a_call(spark, monkeypatch):
    """Many keys, null and odd ones too, cost few calls into Python state, and each keeps its own last change."""
    calls, one = spark.sparkContext.accumulator(0), state._LiveRows.handleInputRows

    def counted(self, key, rows, timerValues):  # noqa: N803
        calls.add(1)
        return one(self, key, rows, timerValues)

    monkeypatch.setattr(state, "BUCKETS", 8)
    monkeypatch.setattr(state._LiveRows, "handleInputRows", counted)
    shape = "action string, ts int, a string, b double, n decimal(20,6)"
    names = [(f"k{i}", float(i % 3)) for i in range(200)] + [(None, 1.0), ("k1", None), (None, None), ("k", float("nan")), ("k", -0.0)]
    folder, root, last = work_path(spark, "in"), work_path(spark, "s"), {}
    for at in range(2):
        changes = [("delete" if (i + at) % 5 == 0 else "upsert", at, *name, Decimal(i + 1000 * at)) for i, name in enumerate(names)]
        last = {i: c for i, c in enumerate(changes)}
        spark.createDataFrame(changes, shape).coalesce(1).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, "parquet", shape, max_files=1)
        state.start_live_counts(stream, ["a", "b"], ["ts"], ["action"], f"{root}/c", jobs.checkpoint_path(root, "c"), ["n"]).awaitTermination()
        live = [c for c in last.values() if c[0] != "delete"]
        assert [tuple(r) for r in state.live_counts(spark, f"{root}/c").collect()] == [("upsert", len(live), sum(c[4] for c in live))]
    assert 0 < calls.value <= 2 * 8


def line(at, event, text, no=0):
    body = text if text.startswith("{") else None
    return (at, event, no, text, body)


def test_settle():
    lines = [line(0, "a", '{"x":'), line(10, "b", "noise"), line(20, "c", "1}"), line(30, "d", '{"y":[')]
    found, rest = state.settle(lines, 120, 100)
    assert found == [("a", 0, '{"x":1}', True)] and rest == lines[2:]
    assert state.settle(lines, 100, 100)[0] == []
    found, rest = state.settle(lines, 1000, 100)
    assert found[1] == ("d", 30, '{"y":[', False) and rest == []
    # An end in the head's own log event does not count, nor one out of reach; the next head takes what follows it.
    assert state.settle([line(0, "a", '{"x":'), line(0, "a", "1}", 1), line(101, "b", "1}")], 500, 100)[0] == [("a", 0, '{"x":', False)]
    assert state.settle([line(0, "a", '{"x":'), line(1, "b", '{"z":'), line(2, "c", "2}")], 500, 100)[0] == [("a", 0, '{"x":', False), ("b", 1, '{"z":2}', True)]


def test_stitching_as_in_a_batch(spark):
    rng, logs = random.Random(8), []
    for i in range(300):
        at, head = 40 * i + rng.randrange(40), rng.random()
        text = f'1 {lineage.SPARK_MARKER}{{"run":{i},' if head < 0.3 else rng.choice(['"a":1}', "noise", '"b":[', "2]}", f'x {lineage.SPARK_MARKER}{{"whole":{i}}}', 'two\n"c":"}"}'])
        logs.append((f"s{rng.randrange(3)}", f"e{i:04d}", at, text))
    frame = spark.createDataFrame(logs, "stream string, event_id string, timestamp long, message string")
    complete, missing = lineage.extract_log_events(frame)
    want = {(*r, True) for r in rows(complete)} | {(*r, False) for r in rows(missing)}
    folder, root = work_path(spark, "in"), work_path(spark, "s")
    beat = spark.createDataFrame([("z", "z", 10**9, "end")], frame.schema)
    for part in (frame.repartition(3), beat):
        part.write.mode("append").parquet(folder)
        found = state.stitched_events(file_stream(spark, folder, "parquet", frame.schema, max_files=2), late="1 minute")
        state.start_batches(found, f"{root}/o", jobs.checkpoint_path(root, "o")).awaitTermination()
    assert {tuple(r) for r in state.read_batches(spark, f"{root}/o", found.schema).collect()} == want
    assert any(not w[4] for w in want) and sum(w[4] for w in want) > 50


def test_sketches_merge(spark):
    values = [(i // 1000, float((i * 7919) % 5000)) for i in range(5000)]
    hours = spark.createDataFrame(values, "h int, v double").withColumn("start", F.timestamp_seconds(F.col("h") * 3600)).groupBy("start").agg(*metrics.sketch_columns("v"))
    day = metrics.sketch_figures(metrics.merged_windows(hours)).head()
    assert day["messages"] == 5000 and day["min"] == 0 and day["max"] == 4999 and day["mean"] == 2499.5
    for p in metrics.PERCENTILES:
        assert abs(day[f"p{p}"] - 50 * p) <= 5000 * metrics.SKETCH_ERROR + 1
    empty = spark.createDataFrame([(0, None)], "h int, v double").withColumn("start", F.timestamp_seconds("h")).groupBy("start").agg(*metrics.sketch_columns("v"))
    assert metrics.sketch_figures(empty).head()["p50"] is None


def test_a_stream_is_started_again(spark, tmp_path):
    root = work_path(spark, "s")
    for n in range(3):
        (tmp_path / f"{n}.txt").write_text(json.dumps(n))
    stream, failures, done = file_stream(spark, str(tmp_path), max_files=1), {0: 1, 2: 1}, []

    def handle(batch, batch_id):
        if failures.get(batch_id, 0):
            failures[batch_id] -= 1
            raise ValueError("now and then")
        done.append(batch_id)

    assert jobs.keep_running(lambda: jobs.start(stream, handle, jobs.checkpoint_path(root, "a"))) == 3 and done == [0, 1, 2]
    failures[0] = 5
    with pytest.raises(Exception, match="now and then"):
        jobs.keep_running(lambda: jobs.start(stream, handle, jobs.checkpoint_path(root, "b")))
    assert failures[0] == 3
