from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.functions.jsonx import infer_schema
from lakeops.operators import docs, sinks
from lakeops.session import work_path


def parsed(spark, items):
    raw = spark.createDataFrame([(json.dumps(i),) for i in items], "value string")
    return raw.select(F.from_json("value", infer_schema(raw, "value")).alias("d")).select("d.*")


def test_unwrap_nested(spark):
    df = parsed(
        spark,
        [
            {
                "_id": {"$oid": "abc"},
                "n": {"$numberInt": "5"},
                "when": {"$date": "2024-01-01T00:00:00Z"},
                "epoch": {"$date": {"$numberLong": "77"}},
                "list": [{"$numberDouble": "1.5"}, None, {"$numberDouble": "2"}],
                "words": ["null", "a"],
                "meta": {"parts": {"k": {"$numberInt": "1"}}, "review": {"grade": {"$numberInt": "3"}}, "note": "null"},
            },
            {"n": {"$numberInt": "oops"}, "when": {"$date": "soon"}, "words": []},
        ],
    )
    out = docs.unwrap_extended_json(df, "millis", ["meta.parts"], ["meta.review.grade"])
    first, second = out.orderBy(F.asc_nulls_last("_id")).collect()
    assert first["_id"] == "abc" and first["n"] == 5 and first["when"] == "1704067200000" and first["epoch"] == 77
    assert first["list"] == [1.5, 2.0] and first["words"] == ["a"]
    assert first["meta"]["parts"] == '{"k":{"$numberInt":"1"}}' and first["meta"]["review"]["grade"] == "3"
    assert first["meta"]["note"] is None
    assert second["n"] is None and second["when"] == "soon" and second["words"] == [] and second["meta"] is None
    action = docs.bulk_actions(docs.with_document_id(out), "idx").filter("_id = 'abc'").head()
    assert "note" not in json.loads(action["_source"])["meta"]


def test_mixed_wrapper_and_plain(spark):
    df = spark.createDataFrame([('{"$numberInt":"5"}',), ("7",), ("null",), (None,)], "price string")
    out = docs.unwrap_extended_json(df, mixed={"price": "bigint"})
    assert sorted(r[0] for r in out.collect() if r[0] is not None) == [5, 7]
    assert out.filter("price is null").count() == 2


def test_empty_objects_vanish(spark):
    df = parsed(spark, [{"a": {"b": "null"}, "c": 1}, {"a": {"b": "x"}, "c": 2}])
    out = docs.unwrap_extended_json(df, drop_empty=True)
    assert rows(out.select("c", F.col("a").isNull()), "c") == [(1, True), (2, False)]


def test_ids_are_stable(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", "k")], "v string, _id string")
    ids = [r["doc_key"] for r in docs.with_document_id(df).orderBy("v").collect()]
    assert ids[0] == ids[1] and len(ids[0]) == 64 and ids[2] == "k"


def test_batches_have_exact_size(spark):
    df = spark.range(25).repartition(6)
    counts = rows(docs.with_batches(df, 10, "id").groupBy("batch").count(), "batch")
    assert counts == [(0, 10), (1, 10), (2, 5)]


def writer(*refuse):
    def open_writer():
        def write(batch):
            if any(a["_id"] in refuse for a in batch):
                raise ValueError("refused")
            return len(batch), 0

        return write

    return open_writer


def test_bulk_write_reports_and_keeps_failures(spark):
    df = spark.range(10).select(F.col("id").alias("doc_key"), (F.col("id") * 2).alias("v")).coalesce(1)
    report, letters = work_path(spark, "r"), work_path(spark, "l")
    stats = docs.bulk_write(docs.bulk_actions(df, "idx"), writer("4"), 3, report, letters)
    assert rows(stats.select("batch", "docs", "ok", "failed", "error"), "batch") == [
        (0, 3, 3, 0, None), (1, 3, 0, 3, "refused"), (2, 3, 3, 0, None), (3, 1, 1, 0, None),
    ]
    (letter,) = spark.read.json(letters).collect()
    assert letter["error"] == "refused" and letter["index"] == "idx"
    assert [(d["_id"], d["v"]) for d in letter["data"]] == [("3", 6), ("4", 8), ("5", 10)]


def test_resume_sends_the_rest(spark):
    df = spark.range(100).select(F.col("id").alias("pos"), F.lit("i").alias("_index"), F.col("id").cast("string").alias("_id"), F.lit("{}").alias("_source"))
    state, report = work_path(spark, "s"), work_path(spark, "r")
    assert docs.load_state(spark, state) is None
    docs.save_state(spark, state, 39, 40, False)
    stats = docs.resumable_load(df, "pos", writer(), 7, state, report, 25)
    assert stats.agg(F.sum("docs")).head()[0] == 60
    done = docs.load_state(spark, state)
    assert (done["position"], done["processed_docs"], done["completed"]) == (99, 100, True)
    again = docs.resumable_load(df, "pos", writer(), 7, state, report, 25)
    assert again.agg(F.sum("docs")).head()[0] == 60


def test_sinks(spark):
    df = spark.createDataFrame([("A", None, 1)], "a string, b string, n int")
    assert rows(sinks.route_index(df, "x-{a}-{b}-z").select("index_name")) == [("x-A--z",)]
    assert sinks.mark_semistructured(df, ["a", "zz"]).schema["a"].metadata == {"super": True, "redshift_type": "super"}
    changes = spark.createDataFrame([("delete", 1), ("insert", 2), ("upsert", 3)], "action string, id int")
    got = sorted(r["value"] for r in sinks.changelog_messages(changes, ["id"]).collect())
    assert got == ['{"after":{"id":2},"op":"c"}', '{"after":{"id":3},"op":"u"}', '{"before":{"id":1},"op":"d"}']
    options = sinks.warehouse_options("jdbc:x", "t", staging="s3://b/t")
    assert options["extracopyoptions"] == "TRUNCATECOLUMNS" and options["tempdir"] == "s3://b/t" and "user" not in options
    sinks.log_sample(df, 1)


@pytest.mark.parametrize("text", ["[1]", "x"])
def test_inference_of_non_objects(spark, text):
    assert infer_schema(spark.createDataFrame([(text,)], "v string"), "v").fields == []
