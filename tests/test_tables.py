from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.operators import tables
from lakeops.session import work_path


def frame(spark, items):
    return spark.createDataFrame(items, "id int, p string, v int")


def files(lake):
    """Names of the data files by folder."""
    found = tables.file_sizes(lake.spark, lake.path).collect()
    out = {}
    for r in found:
        folder, name = r["path"].split(lake.path + "/")[-1].rsplit("/", 1)
        out.setdefault(folder, set()).add(name)
    return out


def test_upsert_delete_and_replay(spark):
    lake = tables.BucketTable(spark, work_path(spark, "t"), ["id"])
    assert lake.snapshot() is None and lake.schema is None
    lake.append(frame(spark, [(1, "a", 1), (2, "b", 2)]))
    for _ in range(2):
        lake.merge(frame(spark, [(2, "b", 20), (3, "c", 30)]))
    lake.delete(frame(spark, [(1, "", 0), (77, "", 0)]))
    lake.upsert(frame(spark, [(3, "x", 7), (3, "c", 30)]), ["v"])
    lake.upsert(frame(spark, [(2, "late", 19), (4, "d", 1)]), ["v"])  # the stored row is later
    assert rows(lake.snapshot(), "id") == [(2, "b", 20), (3, "c", 30), (4, "d", 1)]
    assert rows(tables.BucketTable(spark, lake.path, ["id"], buckets=99).snapshot(), "id") == rows(lake.snapshot(), "id")
    with pytest.raises(ValueError, match="key"):
        tables.BucketTable(spark, lake.path, ["v"])


def test_only_touched_buckets_are_rewritten(spark):
    lake = tables.BucketTable(spark, work_path(spark, "t"), ["id"], buckets=16)
    lake.append(frame(spark, [(i, "a", i) for i in range(200)]))
    before = files(lake)
    assert len(before) == 16
    lake.merge(frame(spark, [(5, "b", 50), (1005, "new", 0)]))
    touched = {f"row_bucket={r[0]}" for r in frame(spark, [(5, "", 0), (1005, "", 0)]).select(tables.bucket_of(["id"], 16)).collect()}
    after = files(lake)
    assert {f for f in after if after[f] != before[f]} == touched
    lake.delete(frame(spark, [(5, "", 0)]))
    assert len({f for f in before if files(lake)[f] != after[f]}) == 1
    assert lake.snapshot().count() == 200


def test_only_touched_partitions_are_rewritten(spark):
    lake = tables.BucketTable(spark, work_path(spark, "t"), ["id"], ["p"], buckets=1)
    lake.append(frame(spark, [(1, "a", 1), (2, "b b/x%", 2), (3, None, 3), (4, "d", 4)]))
    first = files(lake)
    lake.merge(frame(spark, [(2, "e", 22)]))  # moves to another partition, its old folder goes
    lake.merge(frame(spark, [(3, "", 33)]))  # empty is null
    lake.merge(frame(spark, [(5, "a", 5)]))
    last = files(lake)
    assert last["row_bucket=0/p=d"] == first["row_bucket=0/p=d"] and last["row_bucket=0/p=a"] != first["row_bucket=0/p=a"]
    assert len(last) == 4 and not any("b b" in f or "b%20b" in f for f in last)
    assert rows(lake.snapshot(), "id") == [(1, "a", 1), (2, "e", 22), (3, None, 33), (4, "d", 4), (5, "a", 5)]
    lake.overwrite_partitions(frame(spark, [(6, "a", 6)]))
    assert rows(lake.snapshot(), "id") == [(2, "e", 22), (3, None, 33), (4, "d", 4), (6, "a", 6)]
    lake.overwrite(frame(spark, [(7, "z", 7)]))
    assert rows(lake.snapshot()) == [(7, "z", 7)] and len(files(lake)) == 1


def test_a_lost_driver_goes_on(spark):
    """The side folder is whole, but only part of it is in place."""
    lake = tables.BucketTable(spark, work_path(spark, "t"), ["id"], buckets=4)
    lake.append(frame(spark, [(i, "a", i) for i in range(20)]))
    put, lake._put_in_place = lake._put_in_place, lambda: None
    lake.merge(frame(spark, [(i, "b", -i) for i in range(20)]))
    tables._remove(spark, f"{lake.path}/row_bucket=1")
    lake._put_in_place = put
    again = tables.BucketTable(spark, lake.path, ["id"])
    again.recover()
    assert rows(again.snapshot(), "id") == [(i, "b", -i) for i in range(20)]
    # One that is not whole is dropped.
    frame(spark, [(1, "x", 1)]).withColumn("row_bucket", F.lit(0)).write.partitionBy("row_bucket").parquet(again._side)
    tables._remove(spark, f"{again._side}/_SUCCESS")
    again.delete(frame(spark, [(99, "", 0)]))
    assert not tables.path_exists(spark, again._side)
    assert again.snapshot().count() == 20


def test_schema_evolution(spark):
    lake = tables.BucketTable(spark, work_path(spark, "t"), ["id"])
    lake.append(spark.createDataFrame([(1, 1)], "id int, n int"))
    lake.append(spark.createDataFrame([(2, 2.5, "x")], "id bigint, n double, s string"))
    lake.merge(spark.createDataFrame([(1, "text")], "id int, n string"))
    assert rows(lake.snapshot(), "id") == [(1, "text", None), (2, "2.5", "x")]
    lake.merge(spark.createDataFrame([("1", "by text"), ("k", None)], "id string, n string"))
    assert rows(lake.snapshot().select("id", "n"), "id") == [("1", "by text"), ("2", "2.5"), ("k", None)]


def test_apply_from_empty(spark):
    lake = tables.BucketTable(spark, work_path(spark, "t"), ["id"])
    changes = spark.createDataFrame([("insert", 1, 1, "a"), ("delete", 2, 1, None), ("upsert", 3, 2, "b")], "action string, ts int, id int, v string")
    lake.delete(changes)
    lake.apply(changes, ["id"], ["ts"])
    assert rows(lake.snapshot().select("id", "v")) == [(2, "b")]
    lake.apply(spark.createDataFrame([("delete", 9, 2, None)], changes.schema), ["id"], ["ts"])
    assert lake.snapshot().count() == 0
    lake.purge(F.col("ts") < 5)
    assert lake._rows(lake._stored_schema()).count() == 1


change = st.tuples(st.integers(0, 3), st.integers(0, 9), st.booleans())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(change, min_size=1, max_size=5), min_size=1, max_size=4), st.integers(1, 3))
def test_merge_on_read_equals_copy_on_write(spark, batches, compact_after):
    mor = tables.MergeOnReadTable(spark, work_path(spark, "mor"), ["id"], ["ts"], buckets=2)
    cow = tables.BucketTable(spark, work_path(spark, "cow"), ["id"], buckets=2)
    clock = 0
    for number, batch in enumerate(batches):
        items = []
        for key, value, gone in batch:
            clock += 1
            items.append(("delete" if gone else "upsert", clock, key, value))
        df = spark.createDataFrame(items, "action string, ts int, id int, v int")
        for _ in range(2):  # a replay must change nothing
            mor.append(df, number, F.col("action") == "delete")
            cow.apply(df, ["id"], ["ts"])
        mor.compact(compact_after)
    assert rows(mor.snapshot().select("id", "v"), "id") == rows(cow.snapshot().select("id", "v"), "id")


def test_late_change_does_not_revive_a_deleted_key(spark):
    mor = tables.MergeOnReadTable(spark, work_path(spark, "mor"), ["id"], ["ts"])
    mor.append(spark.createDataFrame([(1, 5)], "id int, ts int"), 0, F.lit(True))
    mor.append(spark.createDataFrame([(2, 5)], "id int, ts int"), 1, F.lit(True))
    mor.compact(1)
    mor.append(spark.createDataFrame([(1, 3)], "id int, ts int"), 2)
    assert mor.snapshot().count() == 0


def test_only_full_buckets_are_folded(spark):
    mor = tables.MergeOnReadTable(spark, work_path(spark, "mor"), ["id"], ["ts"], buckets=8)
    mor.append(spark.createDataFrame([(i, 0) for i in range(100)], "id int, ts int"), 0)
    for batch in range(1, 4):
        mor.append(spark.createDataFrame([(7, batch)], "id int, ts int"), batch)
    kept = files(mor)
    assert len(mor.compact(3)) == 1
    now = files(mor)
    assert sum(f in kept and kept[f] == now[f] for f in now) == 7 and len(now) == 8
    assert rows(mor.snapshot().filter("id = 7")) == [(7, 3)] and mor.snapshot().count() == 100
    mor.append(spark.createDataFrame([(7, "x")], "id int, ts string"), 4)  # a type that files cannot be read as
    assert mor.snapshot().count() == 100


def test_late_change_after_an_applied_delete(spark):
    for parts in ([], ["v"]):
        lake = tables.BucketTable(spark, work_path(spark, "t"), ["id"], parts)
        shape = "action string, ts int, n int, id int, v string"

        def apply(*items, lake=lake):
            lake.apply(spark.createDataFrame(items, shape), ["id"], ["ts", "n"])
            return rows(lake.snapshot(), "id")

        assert apply(("upsert", 1, 0, 1, "a"), ("upsert", 1, 0, 2, "a"), ("delete", 5, 0, 3, "c")) == [(1, 0, 1, "a"), (1, 0, 2, "a")]
        assert apply(("delete", 5, 5, 1, None)) == [(1, 0, 2, "a")]
        assert apply(("upsert", 3, 0, 1, "late"), ("upsert", 5, 4, 1, "late"), ("upsert", 4, 0, 3, "late")) == [(1, 0, 2, "a")]
        assert lake.schema.fieldNames() == ["ts", "n", "id", "v"]
        lake.delete(spark.createDataFrame([(2,), (3,)], "id int"))
        assert apply(("upsert", 4, 0, 3, "late")) == []
        lake.merge(spark.createDataFrame([(9, 0, 1, "m")], "ts int, n int, id int, v string"), ["v"], ["ts", "id"])
        assert rows(lake.snapshot().select("ts", "id")) == [(9, 1)]
        assert apply(("upsert", 6, 0, 3, "new")) == [(9, None, 1, None), (6, 0, 3, "new")]


def test_file_writes(spark, tmp_path):
    path = str(tmp_path / "x")
    df = frame(spark, [(i, "a" if i % 3 else "b", i) for i in range(30)])
    tables.bulk_insert(df, path, ["p"], max_records_per_file=7)
    assert tables.file_sizes(spark, path).count() >= 5
    tables.overwrite_partitions(frame(spark, [(100, "b", 1)]), path, ["p"])
    assert spark.read.parquet(path).count() == 21


def test_catalog_statements():
    lake = tables.CatalogTable(None, "cat.db.t")
    assert lake.merge_sql("s", ["id"]) == (
        "MERGE INTO cat.db.t t USING s s ON t.`id` = s.`id` WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    assert "UPDATE SET t.`a` = s.`a` WHEN NOT MATCHED THEN INSERT (`id`, `a`) VALUES (s.`id`, s.`a`)" in lake.merge_sql("s", ["id"], ["a"], ["id", "a"])
    assert "WHERE EXISTS (SELECT 1 FROM s s WHERE t.`id` = s.`id`)" in lake.delete_sql("s", ["id"])
    assert "WHEN MATCHED AND s.action = 'delete' THEN DELETE WHEN MATCHED THEN UPDATE SET t.`v` = s.`v`" in lake.apply_sql("s", ["id"], ["v"])
    assert lake.create_sql(properties={"format-version": "2"}, partition="days(t)").endswith("PARTITIONED BY (days(t)) TBLPROPERTIES ('format-version'='2')")
