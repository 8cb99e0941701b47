from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lakeops.operators import cdc, docs, tables
from lakeops.operators.tables import MergeOnReadTable
from lakeops.session import work_path
from lakeops.sources.readers import file_stream
from lakeops.streaming import jobs


def event(op, key, ts, db="a", table="t", **data):
    row = {"id": key, **data}
    return json.dumps({"before": row if op == "d" else None, "after": None if op == "d" else row,
                       "source": {"db": db, "table": table}, "op": op, "ts_ms": ts})


def put(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(events) + "\n")


TABLES = [cdc.TableConfig("a", "t", timestamp_fields=("at",)), cdc.TableConfig("b", "t"), cdc.TableConfig("a", "none")]


def run(spark, folder, root):
    jobs.start_cdc(file_stream(spark, str(folder), max_files=1), TABLES, root, jobs.checkpoint_path(root, "j")).awaitTermination()
    return jobs.open_tables(spark, TABLES, root)


def test_restart_goes_on_and_columns_appear(spark, tmp_path):
    folder, root = tmp_path / "in", work_path(spark, "s")
    put(folder, "1.txt", [event("c", 1, 1, v=1, at="2024-01-01 00:00:00"), event("c", 1, 1, db="b", v=9), event("c", 2, 1, v=2)])
    lakes = run(spark, folder, root)
    assert rows(lakes[("a", "t")].snapshot().select("id", "v"), "id") == [(1, 1), (2, 2)]
    path = lakes[("a", "t")].path
    before = sorted(r["path"] for r in tables.file_sizes(spark, path).collect())
    run(spark, folder, root)  # nothing new
    assert sorted(r["path"] for r in tables.file_sizes(spark, path).collect()) == before
    put(folder, "2.txt", [event("u", 1, 5, v=1.5, extra="e"), event("u", 1, 4, v=0), event("d", 2, 6, v=2), event("c", 3, 6, v=3), "broken"])
    run(spark, folder, root)
    got = lakes[("a", "t")].snapshot()
    assert rows(got.select("id", "v", "extra"), "id") == [(1, 1.5, "e"), (3, 3.0, None)]
    assert dict(got.dtypes)["at"] == "timestamp"
    assert rows(lakes[("b", "t")].snapshot().select("id", "v")) == [(1, 9)]
    assert lakes[("a", "none")].snapshot() is None


def test_failed_batch_is_repeated(spark, tmp_path):
    folder, root = tmp_path / "in", work_path(spark, "s")
    put(folder, "1.txt", ["x"])
    seen = []

    def failing(batch, batch_id):
        seen.append(batch_id)
        raise ValueError("no")

    checkpoint = jobs.checkpoint_path(root, "f")
    with pytest.raises(Exception):
        jobs.start(file_stream(spark, str(folder)), failing, checkpoint).awaitTermination()
    jobs.start(file_stream(spark, str(folder)), lambda batch, batch_id: seen.append((batch_id, batch.count())), checkpoint).awaitTermination()
    assert seen == [0, (0, 1)]


def test_merge_on_read_stream(spark, tmp_path):
    folder, root = tmp_path / "in", work_path(spark, "s")
    lake = MergeOnReadTable(spark, f"{root}/t", ["id"], ["ts_ms"], buckets=1)
    folder.mkdir()
    stream = cdc.route(cdc.parse_envelope(file_stream(spark, str(folder), max_files=1)), "C")
    changes = cdc.decode(stream.select("action", "ts_ms", cdc.payload().alias("d")), "d", "id int, v int")
    for i in range(4):
        put(folder, f"{i}.txt", [event("u", 1, i, v=i), event("d" if i == 3 else "c", 2, i, v=i)])
        jobs.start_merge_on_read(changes, lake, jobs.checkpoint_path(root, "m"), compact_after=3).awaitTermination()
    assert {b: len(names) for b, names in lake.batches().items()} == {"row_bucket=0": 2}
    assert rows(lake.snapshot().select("id", "v")) == [(1, 3)]


def counting():
    return lambda: lambda batch: (len(batch), 0)


def test_load_and_display(spark, tmp_path):
    folder, root = tmp_path / "in", work_path(spark, "s")
    put(folder, "1.txt", ["a", "b"])
    stream = file_stream(spark, str(folder))
    actions = docs.bulk_actions(stream.select(F.col("value").alias("doc_key")), "i")
    for n in (2, 3):
        jobs.start_load(actions, counting(), 10, f"{root}/r", jobs.checkpoint_path(root, "l")).awaitTermination()
        stats = spark.read.schema(docs.STATS).option("basePath", f"{root}/r").parquet(f"{root}/r")
        assert stats.agg(F.sum("docs")).head()[0] == n
        put(folder, f"{n}.txt", ["c"])
    query = jobs.start_display(stream, jobs.checkpoint_path(root, "d"), 1)
    assert isinstance(query, StreamingQuery)
    query.awaitTermination()
