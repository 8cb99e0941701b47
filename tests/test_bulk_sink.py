"""The bulk load as a sink: reports and dead letters of the attempts that count, loads that come again, streams."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import bulk_sink
from lakeops.session import work_path
from lakeops.sources.readers import file_stream


def actions(spark, n, tasks=3):
    ids = spark.range(n).repartition(tasks)
    return ids.select(F.lit("i").alias("_index"), F.col("id").cast("string").alias("_id"), F.concat(F.lit('{"v":'), "id", F.lit("}")).alias("_source"))


def refusing(*ids):
    def open_writer():
        def write(batch):
            bad = {a["_id"]: "no " + a["_id"] for a in batch if a["_id"] in ids}
            if bad:
                raise bulk_sink.Refused(bad)
            return len(batch), 0

        return write

    return open_writer


def totals(df):
    return tuple(df.agg(*(F.sum(c) for c in ("docs", "ok", "failed", "refused"))).head())


def test_load_and_the_same_load_again(spark):
    path = work_path(spark, "bulk")
    for _ in range(2):
        assert totals(bulk_sink.load(actions(spark, 100), refusing("5", "77"), 7, path, "a")) == (100, 98, 2, 2)
    got = rows(bulk_sink.letters(spark, path).select("load", "error", "index", "id", "source"), "id")
    assert got == [("a", "no 5", "i", "5", '{"v":5}'), ("a", "no 77", "i", "77", '{"v":77}')]
    bulk_sink.load(actions(spark, 10), refusing(), 7, path, "b")
    assert totals(bulk_sink.report(spark, path)) == (110, 108, 2, 2)
    assert bulk_sink.report(spark, path).filter("batches > ceil(docs / 7)").isEmpty()


def test_empty_load(spark):
    path = work_path(spark, "bulk")
    assert bulk_sink.load(actions(spark, 0), refusing(), 7, path, "a").agg(F.coalesce(F.sum("docs"), F.lit(0))).head()[0] == 0
    assert bulk_sink.letters(spark, path).isEmpty()


def test_a_batch_that_raises_is_kept(spark):
    def open_writer():
        def write(batch):
            raise ValueError("all refused")

        return write

    path = work_path(spark, "bulk")
    assert totals(bulk_sink.load(actions(spark, 5, 1), open_writer, 2, path, "a")) == (5, 0, 5, 5)
    assert rows(bulk_sink.letters(spark, path).select("error", "id"), "id") == [("all refused", str(i)) for i in range(5)]


def test_a_lost_target_leaves_nothing(spark, tmp_path):
    def open_writer():
        def write(batch):
            if any(a["_id"] == "9" for a in batch):
                raise bulk_sink.Unavailable("down")
            raise ValueError("refused")

        return write

    path = str(tmp_path / "bulk")
    with pytest.raises(Exception, match="down"):
        bulk_sink.load(actions(spark, 10, 1), open_writer, 2, path, "a")
    assert not [f for _, _, files in os.walk(path) for f in files]


def test_overwrite_is_no_load(spark, tmp_path):
    options = bulk_sink._options(spark, refusing(), 2, str(tmp_path))
    with pytest.raises(Exception, match="mode append"):
        actions(spark, 2).write.format(bulk_sink.NAME).options(**options, load="a").mode("overwrite").save()


RETRY = """
import json, sys
from pyspark import TaskContext
from pyspark.sql import functions as F
from lakeops.operators import bulk_sink
from lakeops.session import build_session

spark = build_session("retry", "local[2,3]", spark__ui__enabled="false")

def open_writer():
    seen = []
    def write(batch):
        seen.append(1)
        if len(seen) == 3 and TaskContext.get().attemptNumber() < 2 and TaskContext.get().partitionId() == 0:
            raise bulk_sink.Unavailable("lost")
        bulk_sink_refused = {a["_id"]: "no" for a in batch if a["_id"].endswith("3")}
        if bulk_sink_refused:
            raise bulk_sink.Refused(bulk_sink_refused)
        return len(batch), 0
    return write

df = spark.range(0, 100, 1, 2).select(F.lit("i").alias("_index"), F.col("id").cast("string").alias("_id"), F.lit("{}").alias("_source"))
out = bulk_sink.load(df, open_writer, 10, sys.argv[1], "a")
total = out.agg(F.sum("docs"), F.sum("ok"), F.sum("failed")).head()
print("RESULT" + json.dumps([list(total), bulk_sink.letters(spark, sys.argv[1]).count(), bulk_sink.letters(spark, sys.argv[1]).select("id").distinct().count()]))
"""


def test_a_task_that_is_tried_again_counts_once(tmp_path):
    script, home = tmp_path / "retry.py", os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script.write_text(RETRY)
    done = subprocess.run(
        [sys.executable, str(script), str(tmp_path / "out")], env={**os.environ, "PYTHONPATH": home}, capture_output=True, text=True, timeout=300
    )
    (line,) = [x for x in done.stdout.splitlines() if x.startswith("RESULT")] or [done.stderr[-3000:]]
    assert json.loads(line.removeprefix("RESULT")) == [[100, 90, 10], 10, 10]
    assert "lost" in done.stderr
    assert not [f for _, _, files in os.walk(tmp_path / "out" / "_staging") for f in files]


def test_stream_loads(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", work_path(spark, "bulk"), work_path(spark, "marks")
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.txt").write_text("\n".join(f"{n}{i}" for i in range(10)))
    lines = file_stream(spark, str(folder), max_files=1)
    stream = lines.select(F.lit("i").alias("_index"), F.col("value").alias("_id"), F.lit("{}").alias("_source"))
    for _ in range(2):
        bulk_sink.start(stream, refusing("13"), 4, path, checkpoint).awaitTermination()
        assert totals(bulk_sink.report(spark, path)) == (30, 29, 1, 1)
    assert [r[0] for r in rows(bulk_sink.letters(spark, path).select("id"))] == ["13"]
