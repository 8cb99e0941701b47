from __future__ import annotations

import json

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import cdc


def event(op, key=1, v="x", ts=1, db="d", table="t", before=True, after=True):
    row = {"id": key, "v": v}
    return json.dumps(
        {
            "before": row if before and op in "ud" else None,
            "after": row if after and op != "d" else None,
            "source": {"db": db, "table": table},
            "op": op,
            "ts_ms": ts,
        }
    )


def frame(spark, events):
    return spark.createDataFrame([(e,) for e in events], "value string")


@pytest.mark.parametrize(
    "policy,expected",
    [
        ("A", {"r": "insert", "c": "insert", "u": "upsert", "d": "delete"}),
        ("B", {"r": "upsert", "c": "insert", "u": "upsert", "d": "delete"}),
        ("C", {"r": "upsert", "c": "upsert", "u": "upsert", "d": "delete"}),
    ],
)
def test_route_policies(spark, policy, expected):
    df = frame(spark, [event(op) for op in "rcud"] + [event("c", after=False), event("d", before=False), "broken", event("x")])
    routed = cdc.route(cdc.parse_envelope(df), policy)
    assert {r["op"]: r["action"] for r in routed.collect()} == expected


def test_envelope_is_parsed_once(spark):
    df = spark.range(5).select(F.concat(F.lit('{"op":"c","after":'), F.col("id").cast("string"), F.lit("}")).alias("value"))
    plan = cdc.route(cdc.parse_envelope(df), "C")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_flink_and_replication(spark):
    flink = frame(spark, [json.dumps({"data": {"id": i}, "op": op}) for i, op in enumerate(["+I", "-U", "+U", "-D"])])
    parsed = cdc.parse_envelope(flink, "flink")
    assert sorted(r["op"] for r in parsed.collect()) == ["c", "d", "u"]
    replicated = frame(spark, ['{"data":{"id":1},"metadata":{"x":1}}', '{"metadata":{}}'])
    assert cdc.parse_envelope(replicated, "replication").count() == 1


def test_dedupe_keeps_one_row_on_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (None, 1, "n")], "id int, o int, v string")
    assert rows(cdc.dedupe_latest(df, ["id"], ["o", "v"]), "id") == [(None, 1, "n"), (1, 5, "b")]


def test_nearest_time(spark):
    df = spark.createDataFrame([("v", 100, 90), ("v", 100, 104), ("v", 100, 108)], "vin string, active long, at long").select(
        "vin", "active", F.timestamp_seconds("at").alias("t")
    )
    nearest = cdc.dedupe_nearest(df, ["vin", "active"], "t", "active")
    assert [r[0] for r in nearest.select(F.unix_seconds("t")).collect()] == [104]


def changes(spark, items):
    return spark.createDataFrame(items, "action string, ts_ms long, id int, v string")


def test_latest_keeps_event_order_and_sequential_does_not(spark):
    current = spark.createDataFrame([(1, "old"), (2, "two")], "id int, v string")
    df = changes(spark, [("delete", 1, 1, None), ("insert", 2, 1, "new"), ("delete", 3, 99, None), ("upsert", 1, 2, "a"), ("upsert", 2, 2, "b")])
    latest = cdc.apply_changelog(current, df, ["id"], ["ts_ms"])
    assert rows(latest.select("id", "v"), "id") == [(1, "new"), (2, "b")]
    sequential = cdc.apply_changelog(current, df, ["id"], ["ts_ms"], mode="sequential")
    assert rows(sequential.select("id", "v"), "id") == [(2, "b")]


change = st.tuples(st.sampled_from(["insert", "upsert", "delete"]), st.integers(0, 4), st.sampled_from("abc"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(change, min_size=1, max_size=12), st.integers(0, 12))
def test_batches_equal_one_pass(spark, items, cut):
    timed = [(a, i, k, v) for i, (a, k, v) in enumerate(items)]
    first, second = timed[:cut], timed[cut:]
    state = None
    for part in (first, second):
        if part:
            state = cdc.apply_changelog(state, changes(spark, part), ["id"], ["ts_ms"])
    whole = cdc.apply_changelog(None, changes(spark, timed), ["id"], ["ts_ms"])
    model = {}
    for action, _, key, v in timed:
        if action == "delete":
            model.pop(key, None)
        else:
            model[key] = v
    assert dict(rows(state.select("id", "v"))) == dict(rows(whole.select("id", "v"))) == model


def test_merge_partial_and_delete(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, s string, n int")
    source = spark.createDataFrame([(2, "x", 99), (3, "y", 30)], "id int, s string, n int")
    merged = cdc.merge_rows(target, source, ["id"], update=["n"], insert=["id", "s"])
    assert rows(merged, "id") == [(1, "a", 10), (2, "b", 99), (3, "y", None)]
    assert rows(cdc.delete_rows(target, source, ["id"]), "id") == [(1, "a", 10)]


def test_demux_keeps_databases_apart(spark):
    df = cdc.with_source(cdc.parse_envelope(frame(spark, [event("c", db="a"), event("c", db="b"), event("c", db="a", table="u")])))
    parts = cdc.demux(df, [cdc.TableConfig("a", "t"), cdc.TableConfig("b", "t")])
    assert {k: v.count() for k, v in parts.items()} == {("a", "t"): 1, ("b", "t"): 1}


def test_decode_modes_and_widening(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":2.5,"b":"x"}'), (3, '{"c":[1,2],"d":{"e f":1}}')], "o int, p string")
    batch = cdc.decode(df, "p")
    assert dict(batch.dtypes) == {"o": "int", "a": "double", "b": "string", "c": "array<bigint>", "d": "struct<e f:bigint>"}
    assert cdc.decode(df, "p", infer="first", order=["o"]).columns == ["o", "a"]
    assert cdc.decode(df, "p", infer="last", order=["o"]).columns == ["o", "c", "d"]
    assert cdc.decode(df, "p", "a double, z int").columns == ["o", "a", "z"]
    mixed = spark.createDataFrame([('{"a":1}',), ('{"a":"t"}',), ('{"a":{"k":1}}',)], "p string")
    assert sorted(r[0] for r in cdc.decode(mixed, "p").collect()) == ["1", "t", '{"k":1}']


def test_schema_union(spark):
    left = spark.createDataFrame([(1, 2)], "id int, n int")
    right = spark.createDataFrame([(2, 2.5, "x")], "id bigint, n double, s string")
    merged = cdc.union_evolved(left, right)
    assert dict(merged.dtypes) == {"id": "bigint", "n": "double", "s": "string"}
    assert rows(merged, "id") == [(1, 2.0, None), (2, 2.5, "x")]
    assert cdc.widen(T.LongType(), T.StringType()) == T.StringType()


def test_ddl_log_and_replay(spark):
    def ddl(kind, db="d", text="alter table x add column c int", changes=None):
        return json.dumps(
            {
                "databaseName": db,
                "tableChanges": json.dumps(changes if changes is not None else [{"id": "1", "type": kind, "table": "{}"}]),
                "source": json.dumps({"db": db, "table": "x", "ts_ms": 5, "pos": 1}),
                "ddl": text,
            }
        )

    df = frame(spark, [ddl("ALTER"), ddl("CREATE"), ddl("ALTER", db="other"), ddl("ALTER", changes=[])])
    work = cdc.schema_changes(df, "d")
    assert rows(work) == [("ALTER", "d", "x", 5, 1, "alter table x add column c int")]
    with pytest.raises(ValueError):
        cdc.replay_ddl(spark, cdc.schema_changes(frame(spark, [ddl("ALTER", text="drop table x")]), "d"))


def test_config_and_small_helpers(spark, tmp_path):
    path = tmp_path / "tables.json"
    path.write_text(json.dumps([{"db": "d", "table": "t", "primary_key": "a,b", "timestamp.fields": ["c"], "format-version": 2}]))
    (config,) = cdc.load_table_config(spark, str(path))
    assert config.primary_key == ("a", "b") and config.timestamp_fields == ("c",) and config.properties == {"format-version": "2"}
    df = spark.createDataFrame([("2024-01-02 03:04:05", "7")], "c string, n string")
    assert cdc.coerce_timestamps(df, ["c", "zz"]).dtypes[0] == ("c", "timestamp")
    assert rows(cdc.map_fields(df, [("n", "int", "m", "bigint")])) == [(7,)]
    assert "ts" in cdc.with_ingest_time(df).columns
